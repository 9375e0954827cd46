"""Spans of the Markov models against a plain version; masking against Python; texts with very many spans."""

import random
import re
import time

from pyspark.sql import functions as F

from tokenloom.llm import secret_scan as ss

SCHEMA = "doc_id bigint, text string"


def _words(chance, n):
    kinds = [
        lambda: "".join(chance.choices("abcdefghijklmnop ", k=chance.randrange(1, 12))),
        lambda: "%032x" % chance.getrandbits(128),
        lambda: "AKIA" + "".join(chance.choices("ABCDEFGHIJ0123456789", k=chance.randrange(8, 20))),
        lambda: "token = " + "".join(chance.choices("abcXYZ0189_-", k=chance.randrange(4, 30))),
        lambda: "".join(chance.choices(ss.ALPHABET, k=chance.randrange(15, 60))),
        lambda: "some_ordinary_identifier_of_the_code",
        lambda: chance.choice(["é漢", "\n", "𝄞x", "-", "=", "\t\x0b"]),
    ]
    return "".join(chance.choice(kinds)() + chance.choice(["", " ", "-", "\n"]) for _ in range(n))


def _plain(text, base, table):
    """Runs of candidate characters, without base spans, that the two models hold to be random."""
    n, found = len(ss.ALPHABET), []
    hidden = set().union(*(range(s, e) for s, e in base)) if base else set()
    for run in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        places, piece = [i for i in range(*run.span()) if i not in hidden], []
        for i in [*places, None]:
            if piece and i != piece[-1] + 1 if i is not None else piece:
                if len(piece) >= 20:
                    value = text[piece[0] : piece[-1] + 1]
                    ratios = [table[ss.ALPHABET.index(a) * n + ss.ALPHABET.index(b)] for a, b in zip(value, value[1:])]
                    if sum(round(x, 9) for x in ratios) >= ss.THRESHOLD * len(ratios):
                        found.append((piece[0], piece[-1] + 1))
                piece = []
            piece.append(i)
    return found


def test_markov_spans_and_masks_equal_a_plain_version(spark):
    chance = random.Random(3)
    rows = [(i, _words(chance, chance.choice([0, 3, 40, 300]))) for i in range(260)] + [(260, None), (261, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    table = ss.fit(docs, docs.select(ss.base_spans(F.coalesce("text", F.lit(""))).alias(ss.BASE)))
    found = {r.doc_id: r for r in ss.scanned(docs).collect()}
    clean = {r.doc_id: r.text for r in ss.secrets_masked(docs).collect()}
    added = 0
    for key, text in rows:
        base = [(s.start, s.end) for s in found[key][ss.BASE]]
        spans = [(s.start, s.end, s.kind, s.value) for s in found[key][ss.ALL]]
        expected = _plain(text or "", base, table)
        assert [s[:2] for s in spans if s[2] == 3] == expected
        assert all((text or "")[s:e] == v for s, e, _, v in spans)
        added += len(expected)
        out, at = "", 0
        for start, end, *_ in spans:
            out += (text[at:start] + "<secret>") if start >= at else ""
            at = max(at, end)
        assert clean[key] == (out + text[at:] if spans else text)
    assert added > 100


def test_many_spans_take_time_in_proportion(spark):
    chance, times = random.Random(1), []
    for n in (4_000, 32_000):
        text = " ".join("%032x" % chance.getrandbits(128) for _ in range(n))
        docs = spark.createDataFrame([(1, text)], SCHEMA)
        start = time.time()
        out = ss.secrets_masked(docs).first().text
        times.append(time.time() - start)
        assert out == " ".join(["<secret>"] * n)
    assert times[1] < 8 * 2 * times[0] + 10
