"""Secrets in text: fixed patterns, and character Markov models of random strings and ordinary identifiers.

Everything runs as built-in expressions. The two models are tables of transition counts,
learned from labelled samples: values that the patterns find, and words beside them.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds of secrets, their patterns and shortest lengths (of group 2 for the first).
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 8
# Runs are taken whole, so a least length in the pattern drops the same matches as a later test.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "markov")

BASE, ALL = "__base_spans", "__all_spans"

#: Characters of the models; identifiers of the least length that the models judge.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE_LEAST = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{CANDIDATE_LEAST},}}"
IDENTIFIER = r"[A-Za-z0-9+/_=-]{4,}"
#: Mean log-likelihood ratio per transition, in nats, from which a string is held to be random.
THRESHOLD = 0.5
#: Count added to each transition.
SMOOTHING = 1.0
#: Bound of the training sample: documents that give ordinary identifiers, by hash of the id.
TRAIN_DOCUMENTS = 4_000


def _running(values: Column, combine) -> Column:
    """What ``combine`` makes of the values up to each place: distances double, so n values take about n log n steps."""
    doublings = F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int")
    rounds = F.when(doublings > 0, F.sequence(F.lit(0), doublings - 1)).otherwise(F.array().cast("array<int>"))

    def step(found: Column, k: Column) -> Column:
        reach = F.pow(F.lit(2), k).cast("int")
        return F.transform(found, lambda x, i: F.when(i < reach, x).otherwise(combine(x, F.get(found, i - reach))))

    return F.aggregate(rounds, values, step)


SPANS = "array<struct<start:int,end:int,kind:int,value:string>>"


def _spans(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """``start, end, kind, value`` of the matches, in code points: what lies between matches gives the places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.transform(F.split(text, pattern, -1), F.char_length), 1, F.size(found))
    ends = _running(F.zip_with(gaps, found, lambda gap, value: gap + F.char_length(value)), lambda a, b: a + b)
    spans = F.zip_with(ends, found, lambda end, value: F.struct(
        (end - F.char_length(value)).alias("start"), end.alias("end"), F.lit(KINDS.index(kind)).alias("kind"), value.alias("value")))
    return F.filter(spans, keep) if keep else spans


def _may_hold(text: Column, pattern: str, spans: Column) -> Column:
    """The spans, or none without further work if the pattern does not occur."""
    return F.when(F.rlike(text, F.lit(pattern)), spans).otherwise(F.array().cast(SPANS))


def _assigned(value: Column) -> Column:
    return F.regexp_extract(value, ASSIGN, 2)


def base_spans(text: Column) -> Column:
    """All spans of the fixed patterns, by start and kind."""
    each = [
        _may_hold(text, ASSIGN, _spans(text, ASSIGN, "assign", lambda s: F.char_length(_assigned(s["value"])) >= ASSIGN_LEAST)),
        _may_hold(text, ACCESS, _spans(text, ACCESS, "access")),
        _may_hold(text, HEX, _spans(text, HEX, "hex")),
    ]
    return F.array_sort(F.concat(*each))


def _transitions(strings: Column) -> Column:
    """Neighbouring characters of each string as places in the table of the models."""
    n = len(ALPHABET)
    place = F.array(*(F.lit(ALPHABET.find(chr(i)) if chr(i) in ALPHABET else None).cast("int") for i in range(128)))

    def of_one(value: Column) -> Column:
        codes = F.transform(F.split(value, ""), lambda c: F.get(place, F.ascii(c)))
        return F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes)), lambda a, b: a * n + b)

    return of_one(strings)


def _counts(strings: DataFrame) -> dict[int, int]:
    """How often each transition occurs in the column ``value``; as many rows as the alphabet squared at most."""
    each = strings.where(F.length("value") > 1).select(F.explode(_transitions(F.col("value"))).alias("pair"))
    return {r["pair"]: r["n"] for r in each.where("pair is not null").groupBy("pair").agg(F.count(F.lit(1)).alias("n")).collect()}


def log_ratios(random: dict[int, int], ordinary: dict[int, int]) -> list[float]:
    """Log of the ratio of the two smoothed transition probabilities, for each pair of characters."""
    import math

    n = len(ALPHABET)
    table = []
    for a in range(n):
        totals = [sum(c.get(a * n + b, 0) for b in range(n)) + SMOOTHING * n for c in (random, ordinary)]
        for b in range(n):
            p, q = ((c.get(a * n + b, 0) + SMOOTHING) / t for c, t in zip((random, ordinary), totals))
            table.append(math.log(p / q))
    return table


def fit(docs: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text") -> list[float]:
    """The table of log ratios.

    Random strings: the values of all base spans (of an assignment its right side).
    Ordinary identifiers: those of a sample of documents, TRAIN_DOCUMENTS by hash of the
    id, outside base spans. ``spans`` has them in an array column.
    """
    value = F.when(F.col("span.kind") == 0, _assigned(F.col("span.value"))).otherwise(F.col("span.value"))
    random = _counts(spans.where(F.size(BASE) > 0).select(F.explode(BASE).alias("span")).select(value.alias("value")))
    chosen = docs.select(key).where(F.col(key).isNotNull()).orderBy(F.xxhash64(key), key).limit(TRAIN_DOCUMENTS).distinct()
    sample = docs.select(key, text).join(F.broadcast(chosen), key)  # TRAIN_DOCUMENTS ids at most
    plain = F.col(text)
    for pattern in (ASSIGN, ACCESS, HEX):
        plain = F.regexp_replace(plain, pattern, " ")
    words = sample.select(F.explode(F.regexp_extract_all(plain, F.lit(IDENTIFIER), F.lit(0))).alias("value"))
    return log_ratios(random, _counts(words))


def markov_spans(text: Column, base: Column, table: list[float]) -> Column:
    """Identifiers, or their parts, outside base spans whose mean log ratio reaches the threshold."""
    ratios = F.array(*(F.lit(round(x, 9)) for x in table))

    def is_random(span: Column) -> Column:
        pairs = _transitions(span["value"])
        total = F.aggregate(pairs, F.lit(0.0), lambda acc, pair: acc + F.get(ratios, pair))
        return total >= THRESHOLD * F.size(pairs)

    # Base spans become blanks, which no identifier holds: places stay, and only what lies beside the spans is judged.
    blank = _replaced(text, base, lambda covered, begins: F.repeat(F.lit(" "), covered))
    free = F.when(F.size(base) == 0, text).otherwise(blank)
    return _may_hold(text, CANDIDATE, F.filter(_spans(free, CANDIDATE, "markov"), is_random))


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of ``docs`` with two of spans: BASE, of the patterns, and ALL, of patterns and models together.

    One row per row of ``docs``; a null text has no span. Spans go by start and kind; ends are
    exclusive and places count code points.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    based = docs.withColumn(BASE, base_spans(whole))
    table = fit(docs.select(key, whole.alias(text)), docs.select(base_spans(whole).alias(BASE)), key, text)
    return based.withColumn(ALL, F.array_sort(F.concat(BASE, markov_spans(whole, F.col(BASE), table))))


def secrets_masked(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str = "n_chars") -> DataFrame:
    """The columns of ``docs`` with each secret replaced in the text, and the length of changed texts counted anew."""
    found = scanned(docs, key, text)
    hit = F.size(ALL) > 0
    clean = found.withColumn(text, F.when(hit, masked(F.col(text), F.col(ALL))).otherwise(F.col(text)))
    if length in docs.columns:
        counted_anew = F.when(hit, F.char_length(text)).otherwise(F.col(length)).cast(docs.schema[length].dataType)
        clean = clean.withColumn(length, counted_anew)
    return clean.select(*docs.columns)


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of each, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


#: Code points of a block of text: a cut reads the blocks that it touches, not the text from its front.
BLOCK = 256


def _replaced(text: Column, spans: Column, filler) -> Column:
    """The text with what ``filler`` gives for each span, sorted by start, in its place.

    ``filler`` is called with the number of code points that the span covers beyond those before it, and
    whether it starts where these end or later. Linear in the text and the spans, but for a logarithm.
    """
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    reached = _running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))

    def cut(blocks: Column, low: Column, high: Column) -> Column:
        first = F.floor(low / BLOCK).cast("int")
        touched = F.slice(blocks, first + 1, F.ceil(high / BLOCK).cast("int") - first)
        return F.when(high > low, F.substring(F.array_join(touched, ""), low - first * BLOCK + 1, high - low)).otherwise("")

    def parts(state: Column) -> Column:
        def one(span: Column, i: Column) -> Column:
            before = F.when(i == 0, F.lit(0)).otherwise(F.get(state["reached"], i - 1))
            covered = F.get(state["reached"], i) - F.greatest(before, span["start"])
            return F.concat(cut(state["blocks"], before, span["start"]), filler(covered, span["start"] >= before))

        rest = cut(state["blocks"], F.element_at(state["reached"], -1), F.char_length(text))
        return F.concat(F.array_join(F.transform(spans, one), ""), rest)

    # Bound to a variable, so that blocks and places are made once for a text.
    state = F.array(F.struct(blocks.alias("blocks"), reached.alias("reached")))
    return F.get(F.transform(state, parts), F.lit(0))


def masked(text: Column, spans: Column, mask: str = "<secret>") -> Column:
    """The text with each span, or run of overlapping spans, replaced by the mask."""
    hidden = _replaced(text, spans, lambda covered, begins: F.when(begins, F.lit(mask)).otherwise(""))
    return F.when(F.size(spans) == 0, text).otherwise(hidden)
