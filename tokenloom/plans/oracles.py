"""The registered queries as plain SQL on the same tables, for comparison.

The SQL goes another way than the operators where it can: regular expressions without
look-ahead, one merge per step with a full recount, all pairs of rows for attention.
"""

from tokenloom.functions.text import code_ranges, members
from tokenloom.plans import queries as q

# The white space characters of Unicode, as a character class.
_SPACES = (
    r"\x{9}-\x{D}\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
_MARK = r"\x{E000}"
_DELIMITED = "replace(text, chr(10), '<|endoftext|>')"
_TURNS = "SELECT conv_id * (SELECT max(turn) + 1 FROM conversations) + turn AS doc_id, text FROM conversations"
_DOCUMENTS = "SELECT doc_id, text FROM documents"


def _pretokens(text: str) -> str:
    """A mark before the last space of a run that precedes a word replaces look-ahead."""
    marked = rf"regexp_replace({text}, '([{_SPACES}])([^{_SPACES}])', chr(57344) || '\1\2', 'g')"
    word = rf"'(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACES}\p{{L}}\p{{N}}{_MARK}]+|[{_SPACES}]+"
    return f"regexp_extract_all({marked}, $${word}$$)"


def _pretokens_of_any(text: str) -> str:
    """As above for any characters, with letters and numbers spelled out as ranges."""
    letters, numbers = code_ranges(members(r"\p{L}")), code_ranges(members(r"\p{N}"))
    return _pretokens(text).replace(r"[^" + _SPACES + r"\p{L}\p{N}", "[^" + _SPACES + letters + numbers).replace(
        r"\p{L}+", f"[{letters}]+").replace(r"\p{N}+", f"[{numbers}]+")


def _points() -> str:
    """The code points of a document, spread out; see the query."""
    n = q.POINT_PARTS
    codes = f"list_filter(list_transform(range({0x110000 // n}), lambda i: i * {n} + doc_id % {n}), lambda c: c > 0 AND NOT c BETWEEN 55296 AND 57344)"
    each = "'x' || chr(c::INT) || '7' || chr(c::INT) || ' ' || chr(c::INT) || 'y ' || chr(c::INT) || chr(c::INT)"
    return f"coalesce(text, '') || array_to_string(list_transform({codes}, lambda c: {each}), '')"


def _pieces(text: str) -> str:
    alternation = "|".join(s.replace("|", r"\|") for s in sorted(q.SPECIALS, key=len, reverse=True))
    marked = rf"regexp_replace({text}, '({alternation})', chr(1) || '\1' || chr(1), 'g')"
    return f"list_filter(string_split({marked}, chr(1)), lambda p: p <> '')"


def _special_list() -> str:
    return ", ".join(f"'{s}'" for s in q.SPECIALS)


def _rows(key: str, source: str, items: str, names: tuple[str, str]) -> str:
    """One row per list element with its position from 0."""
    pos, item = names
    return (
        f"SELECT {key}, unnest(items) AS {item}, generate_subscripts(items, 1) - 1 AS {pos} "
        f"FROM (SELECT {key}, {items} AS items FROM {source})"
    )


_SPACED = r"regexp_replace(hex({0}), '(..)', ' \1 ', 'g')"


def _counts() -> list[str]:
    return [
        f"counts AS MATERIALIZED (SELECT token, count(*) AS n FROM "
        f"(SELECT unnest({_pretokens('text')}) AS token FROM documents) GROUP BY token)"
    ]


def _pairs(words: str) -> str:
    return (
        "SELECT p[1] AS l, p[2] AS r, sum(n) AS n FROM ("
        "SELECT unnest(list_zip(t[1:len(t) - 1], t[2:])) AS p, n FROM ("
        f"SELECT string_split(trim(s), '  ') AS t, n FROM {words}) WHERE len(t) > 1) GROUP BY ALL"
    )


def _training(merges: int = q.N_MERGES, counts: list[str] | None = None) -> list[str]:
    parts = counts or _counts()
    parts.append(f"w0 AS MATERIALIZED (SELECT {_SPACED.format('token')} AS s, n FROM counts)")
    for i in range(1, merges + 1):
        parts.append(
            f"m{i} AS MATERIALIZED (SELECT l, r FROM ({_pairs(f'w{i - 1}')}) ORDER BY n DESC, l DESC, r DESC LIMIT 1)"
        )
        parts.append(
            f"w{i} AS MATERIALIZED (SELECT replace(s, ' ' || l || '  ' || r || ' ', ' ' || l || r || ' ') AS s, n "
            f"FROM w{i - 1}, m{i})"
        )
    union = " UNION ALL ".join(f"SELECT {i - 1} AS rank, l AS left_hex, r AS right_hex FROM m{i}" for i in range(1, merges + 1))
    parts.append(f"merges AS MATERIALIZED ({union})")
    base = 256 + len(q.SPECIALS)
    specials = " UNION ALL ".join(
        f"SELECT {256 + i}, hex('{s}'), true" for i, s in enumerate(q.SPECIALS))
    parts.append(
        "vocab AS MATERIALIZED (SELECT i::INT AS token_id, printf('%02X', i) AS token_hex, false AS is_special "
        f"FROM range(256) t(i) UNION ALL {specials} "
        f"UNION ALL SELECT {base} + rank, left_hex || right_hex, false FROM merges)"
    )
    return parts


def _encoding(docs: str, name: str = "enc") -> list[str]:
    """``name(doc_id, ids)`` of a query giving ``doc_id, text``."""
    steps = [
        f"docs AS MATERIALIZED ({docs})",
        f"pieces AS ({_rows('doc_id', 'docs', _pieces('text'), ('piece_pos', 'piece'))})",
        "toks AS MATERIALIZED (SELECT doc_id, piece_pos, unnest(items) AS token, generate_subscripts(items, 1) AS tok_pos "
        f"FROM (SELECT doc_id, piece_pos, CASE WHEN piece IN ({_special_list()}) THEN [piece] "
        f"ELSE {_pretokens('piece')} END AS items FROM pieces))",
        f"e0 AS MATERIALIZED (SELECT token, {_SPACED.format('token')} AS s FROM (SELECT DISTINCT token FROM toks) "
        f"WHERE token NOT IN ({_special_list()}))",
    ]
    for i in range(1, q.N_MERGES + 1):
        steps.append(
            f"e{i} AS MATERIALIZED (SELECT token, replace(s, ' ' || l || '  ' || r || ' ', ' ' || l || r || ' ') AS s "
            f"FROM e{i - 1}, m{i})"
        )
    last = f"e{q.N_MERGES}"
    steps += [
        "by_hex AS (SELECT token_hex, max(token_id) AS token_id FROM vocab GROUP BY token_hex)",
        "word_ids AS MATERIALIZED (SELECT token, list(token_id ORDER BY p) AS ids FROM ("
        "SELECT token, unnest(parts) AS h, generate_subscripts(parts, 1) AS p FROM ("
        f"SELECT token, string_split(trim(s), '  ') AS parts FROM {last})) JOIN by_hex ON h = token_hex GROUP BY token "
        f"UNION ALL SELECT token, [token_id] FROM (SELECT unnest([{_special_list()}]) AS token) JOIN by_hex ON hex(token) = token_hex)",
        f"{name} AS MATERIALIZED (SELECT doc_id, coalesce(ids, []) AS ids FROM docs LEFT JOIN ("
        "SELECT doc_id, flatten(list(ids ORDER BY piece_pos, tok_pos)) AS ids FROM toks JOIN word_ids USING (token) "
        "GROUP BY doc_id) USING (doc_id))",
    ]
    return steps


_STREAM = [
    "long_ids AS (SELECT doc_id, unnest(ids) AS token_id, generate_subscripts(ids, 1) AS pos FROM enc)",
    "stream AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id, pos) - 1 AS gpos, doc_id, token_id FROM long_ids)",
]


def _with(parts: list[str], final: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + final


def _text(ids: str) -> str:
    return f"array_to_string({ids}, ' ')"


def _printable() -> str:
    return (
        "alphabet AS (SELECT h, chr(CASE WHEN ok THEN b ELSE (256 + row_number() OVER (PARTITION BY ok ORDER BY b) - 1) END::INT) "
        "AS c FROM (SELECT i AS b, printf('%02X', i) AS h, i BETWEEN 33 AND 126 OR i BETWEEN 161 AND 172 OR "
        "i BETWEEN 174 AND 255 AS ok FROM range(256) t(i)))"
    )


def _shown(hexes: str, source: str, keys: str) -> str:
    """``keys, shown`` for the hex column of a source."""
    return (
        f"SELECT {keys}, string_agg(c, '' ORDER BY p) AS shown FROM (SELECT {keys}, unnest(hs) AS hx, "
        f"generate_subscripts(hs, 1) AS p FROM (SELECT {keys}, regexp_extract_all({hexes}, '..') AS hs FROM {source})) "
        f"JOIN alphabet ON hx = h GROUP BY {keys}"
    )


def _repaired(hexes: str) -> str:
    """Hex to text: well-formed characters, or the mark for each longest malformed prefix."""
    tail = "[89AB][0-9A-F]"
    well = [
        "[0-7][0-9A-F]", f"(?:C[2-9A-F]|D[0-9A-F]){tail}", f"E0[AB][0-9A-F]{tail}",
        f"(?:E[1-9A-CEF]){tail}{tail}", f"ED[89][0-9A-F]{tail}", f"F0[9AB][0-9A-F]{tail}{tail}",
        f"F[1-3]{tail}{tail}{tail}", f"F48[0-9A-F]{tail}{tail}",
    ]
    cut = [
        "E0[AB][0-9A-F]", f"(?:E[1-9A-CEF]){tail}", "ED[89][0-9A-F]", f"F0[9AB][0-9A-F](?:{tail})?",
        f"F[1-3]{tail}(?:{tail})?", f"F48[0-9A-F](?:{tail})?", "[89A-F][0-9A-F]",
    ]
    units = f"regexp_extract_all({hexes}, '{'|'.join(well + cut)}')"
    ok = f"regexp_full_match(u, '{'|'.join(well)}')"
    return f"array_to_string(list_transform({units}, lambda u: CASE WHEN {ok} THEN decode(unhex(u)) ELSE chr(65533) END), '')"


_VECTORS = (
    "vectors AS MATERIALIZED (SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS dim, "
    "unnest(embedding)::DOUBLE AS x FROM embeddings)"
)


def _round(value: str) -> str:
    return f"round({value}, 6) + 0.0"


def _attention(allowed: str) -> str:
    return _with(
        [
            _VECTORS,
            "scores AS (SELECT a.label, a.vec_id AS q_id, b.vec_id AS k_id, sum(a.x * b.x) / sqrt(64.0) AS s "
            f"FROM vectors a JOIN vectors b ON a.label = b.label AND a.dim = b.dim AND {allowed} GROUP BY ALL)",
            "tops AS (SELECT q_id, max(s) AS top FROM scores GROUP BY q_id)",
            "weights AS (SELECT label, q_id, k_id, exp(s - top) AS w FROM scores JOIN tops USING (q_id))",
            "masses AS (SELECT q_id, sum(w) AS mass FROM weights GROUP BY q_id)",
        ],
        f"SELECT w.label AS batch, q_id, dim, {_round('sum(w * x / mass)')} AS value FROM weights w "
        "JOIN masses USING (q_id) JOIN vectors v ON v.vec_id = k_id GROUP BY ALL",
    )


def _roles() -> str:
    return "roles AS (SELECT '<|' || role || '|>' AS s, row_number() OVER (ORDER BY role) - 1 AS nth FROM (SELECT DISTINCT role FROM conversations))"


def _clean_chunks() -> str:
    size = "13"  # bytes of the delimiter
    return _with(
        [
            f"parts AS ({_rows('doc_id', 'documents', f'string_split({_DELIMITED}, ' + chr(39) + '<|endoftext|>' + chr(39) + ')', ('p', 'part'))})",
            f"ends AS (SELECT sum(strlen(part) + {size}) OVER (ORDER BY doc_id, p) AS stop FROM parts)",
            f"total AS (SELECT max(stop)::BIGINT AS size, max(stop)::BIGINT // {q.N_CHUNKS} AS step FROM ends)",
            f"guesses AS (SELECT i * step AS guess, size FROM total, range(1, {q.N_CHUNKS}) t(i))",
            f"starts AS (SELECT (stop - {size})::BIGINT AS found FROM ends)",
            "inner_cuts AS (SELECT coalesce(found, size) AS boundary FROM guesses ASOF LEFT JOIN starts ON found >= guess)",
        ],
        "SELECT DISTINCT boundary FROM (SELECT boundary FROM inner_cuts UNION ALL SELECT 0 UNION ALL SELECT size FROM total)",
    )


def _oracles() -> dict[str, str]:
    train = _training()
    docs = train + _encoding(_DOCUMENTS)
    delimited = train + _encoding(f"SELECT doc_id, {_DELIMITED} AS text FROM documents")
    turns = train + _encoding(_TURNS)
    first_pairs = [*_counts(), f"w0 AS (SELECT {_SPACED.format('token')} AS s, n FROM counts)",
                   f"pairs AS ({_pairs('w0')})"]
    pair_columns = "l AS left_hex, r AS right_hex, n::BIGINT AS n"
    ranked = "ORDER BY n DESC, l DESC, r DESC LIMIT"
    tables = (
        "SELECT 'vocab' AS kind, token_id AS no, token_hex AS a, '' AS b FROM vocab "
        "UNION ALL SELECT 'merge', rank, left_hex, right_hex FROM merges"
    )
    encoded = f"SELECT doc_id, {_text('ids')} AS ids FROM enc"
    pretokens = f"SELECT token, count(*) AS n FROM (SELECT unnest({_pretokens('text')}) AS token FROM documents) GROUP BY token"
    runs = "replace(text, '. ', '. ' || chr(160) || chr(10) || '  ')"
    m = q.CONTEXT
    window = "list(token_id) OVER (ORDER BY gpos ROWS BETWEEN {0} FOLLOWING AND {1} FOLLOWING)"
    windows = (
        f"windows AS (SELECT gpos AS start, {window.format(0, m - 1)} AS x, {window.format(1, m)} AS y FROM stream "
        f"QUALIFY gpos < count(*) OVER () - {m})"
    )
    all_windows = _with(turns + _STREAM + [windows], f"SELECT start, {_text('x')} AS x, {_text('y')} AS y FROM windows")
    fixed_batch = _with(
        docs + _STREAM + [
            f"starts AS (SELECT i AS sample_id, (i * 7919) % ((SELECT count(*) FROM stream) - {m}) AS start FROM range({q.BATCH}) t(i))",
        ],
        f"SELECT sample_id, start, string_agg(token_id::VARCHAR, ' ' ORDER BY gpos) FILTER (gpos < start + {m}) AS x, "
        f"string_agg(token_id::VARCHAR, ' ' ORDER BY gpos) FILTER (gpos > start) AS y FROM ("
        f"SELECT sample_id, start, start + unnest(range({m + 1})) AS gpos FROM starts) JOIN stream USING (gpos) GROUP BY sample_id, start",
    )
    logits = "embedding"
    loss = "ln(list_sum(list_transform(l, lambda x: exp(x - list_max(l))))) + list_max(l) - l[label + 1]"
    losses = " UNION ALL ".join(
        f"SELECT {s} AS scale, {_round(f'avg({loss})')} AS loss, count(*) AS n_rows FROM "
        f"(SELECT label, list_transform({logits}, lambda x: x::DOUBLE * {s}) AS l FROM embeddings)"
        for s in (1, 1000)
    )
    return {
        "corpus_scan": "SELECT doc_id, text, strlen(text)::INT AS n_bytes FROM documents",
        "chunk_boundaries": _clean_chunks(),
        "document_split": _rows("doc_id", "documents", f"string_split({_DELIMITED}, '<|endoftext|>')", ("part_pos", "text")),
        "utf8_ignore": "SELECT doc_id, text || text || text AS text FROM documents",
        "artifact_roundtrip": _with(_training(q.N_SAVED), tables),
        "gpt2_import": _with(_training(q.N_SAVED), tables),
        "gpt2_export": _with(
            train + [
                _printable(),
                f"v AS ({_shown('token_hex', 'vocab', 'token_id')})",
                f"a AS ({_shown('left_hex', 'merges', 'rank')})",
                f"b AS ({_shown('right_hex', 'merges', 'rank')})",
            ],
            "SELECT 'vocab' AS kind, token_id AS no, shown AS line FROM v UNION ALL "
            "SELECT 'merge', rank, a.shown || ' ' || b.shown FROM a JOIN b USING (rank)",
        ),
        # Each text is followed by the delimiter; the malformed bytes around it are dropped.
        "delimited_files": pretokens,
        "delimited_ranges": "SELECT (sum(strlen(t) + 13) OVER (ORDER BY doc_id) - strlen(t) - 13)::BIGINT AS doc_id, "
        "strlen(t)::INT AS n_bytes, md5(t) AS digest FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)",
        "special_split": f"SELECT doc_id, piece_pos, piece, piece IN ({_special_list()}) AS is_special FROM ("
        + _rows("doc_id", "documents", _pieces(_DELIMITED), ("piece_pos", "piece")) + ")",
        "pretokenize": _rows("doc_id", "documents", _pretokens("text"), ("tok_pos", "token")),
        "pretokenize_code_points": f"SELECT doc_id, len(w) AS n_tokens, md5(array_to_string(w, chr(10))) AS digest FROM ("
        f"SELECT doc_id, {_pretokens_of_any('t')} AS w FROM (SELECT doc_id, {_points()} AS t FROM documents))",
        "pretokenize_runs": _rows("doc_id", "documents", _pretokens(runs), ("tok_pos", "token")),
        "byte_sequences": f"SELECT token, {_SPACED.format('token')} AS bytes_hex FROM ({pretokens})",
        "special_encode": _with(delimited, encoded),
        "vocab_leak_check": _with(train, "SELECT count(*) AS n_leaks FROM vocab WHERE NOT is_special AND token_hex LIKE '%3C7C%'"),
        "pretoken_counts": pretokens,
        "corpus_stats": f"SELECT sum(n)::BIGINT AS total_words, count(*) AS unique_words FROM ({pretokens})",
        "pair_stats": _with(first_pairs, f"SELECT {pair_columns} FROM pairs"),
        "best_pair": _with(first_pairs, f"SELECT {pair_columns} FROM pairs {ranked} 1"),
        "top_pairs": _with(first_pairs, f"SELECT {pair_columns} FROM pairs {ranked} {q.TOP}"),
        # Words of one byte hold no pair and are not in the word table.
        "apply_merge": _with(
            [*first_pairs, f"m1 AS (SELECT l, r FROM pairs {ranked} 1)"],
            f"SELECT replace({_SPACED.format('token')}, ' ' || l || '  ' || r || ' ', ' ' || l || r || ' ') AS word_hex, n "
            "FROM counts, m1 WHERE strlen(token) > 1",
        ),
        "train_exhausted": _with(
            _training(q.N_EXHAUSTED, ["counts AS MATERIALIZED (SELECT lang AS token, count(*) AS n FROM documents GROUP BY lang)"]),
            "SELECT * FROM merges",
        ),
        "train_bpe": _with(train, "SELECT * FROM merges"),
        "trained_vocab": _with(train, "SELECT * FROM vocab"),
        "base_vocab": _with(
            [_roles()],
            "SELECT i AS token_id, printf('%02X', i) AS token_hex, false AS is_special FROM range(256) t(i) "
            "UNION ALL SELECT 256 + nth, hex(s), true FROM roles",
        ),
        "extend_vocab": _with(
            train + [_roles()],
            "SELECT token_id, token_hex, is_special FROM vocab UNION ALL "
            "SELECT (SELECT max(token_id) FROM vocab) + 1 + nth, hex(s), true FROM roles",
        ),
        "longest_tokens": _with(
            train,
            "SELECT token_id, token_hex, strlen(token_hex) // 2 AS n_bytes FROM vocab "
            f"ORDER BY n_bytes DESC, token_hex DESC, token_id DESC LIMIT {q.TOP}",
        ),
        "encode_words": _with(docs, f"SELECT token, {_text('ids')} AS ids FROM word_ids WHERE token NOT IN ({_special_list()})"),
        "encode_documents": _with(docs, encoded),
        "encode_documents_arrow": _with(docs, encoded),
        "encode_kept_words": _with(docs, encoded),
        "encode_stream": _with(docs, encoded),
        "decode_documents": _DOCUMENTS,
        "token_strings": _with(
            turns + [f"shown AS (SELECT token_id, {_repaired('token_hex')} AS token_text FROM vocab)"],
            "SELECT doc_id, pos, token_text FROM (SELECT doc_id, unnest(ids) AS token_id, "
            "generate_subscripts(ids, 1) - 1 AS pos FROM enc) JOIN shown USING (token_id)",
        ),
        "roundtrip_mismatches": "SELECT count(*) AS n_rows, 0 AS n_bad FROM documents",
        "token_counts": _with(docs, "SELECT token_id, count(*) AS n FROM (SELECT unnest(ids) AS token_id FROM enc) GROUP BY token_id"),
        "token_stream": _with(docs + _STREAM, "SELECT gpos, doc_id, token_id FROM stream"),
        "lm_windows": all_windows,
        "stored_windows": all_windows,
        "lm_batch": _with(
            docs, f"SELECT {q.SAMPLES} AS n_samples, 0 AS bad_windows, 0 AS bad_starts, 0 AS bad_cells, sum(len(ids))::BIGINT AS n_ids FROM enc"),
        "lm_batch_fixed": fixed_batch,
        "stored_batch": fixed_batch,
        "embedding_lookup": _with(
            train + _encoding("SELECT item_id AS doc_id, text FROM benchmark"),
            f"SELECT doc_id, pos, token_id, (generate_subscripts(embedding, 1) - 1)::INT AS dim, {_round('unnest(embedding)::DOUBLE')} AS value FROM ("
            "SELECT doc_id, unnest(ids) AS token_id, generate_subscripts(ids, 1) - 1 AS pos FROM enc) "
            "JOIN embeddings ON vec_id = token_id",
        ),
        "vector_project": _with(
            [_VECTORS, "means AS (SELECT label, dim, avg(x) AS w FROM vectors GROUP BY label, dim)"],
            f"SELECT vec_id, (dense_rank() OVER (ORDER BY o) - 1)::INT AS dim, value FROM ("
            f"SELECT v.vec_id, m.label AS o, {_round('sum(x * w)')} AS value FROM vectors v JOIN means m USING (dim) GROUP BY ALL)",
        ),
        "rms_normalize": _with(
            [_VECTORS, "norms AS (SELECT vec_id, sqrt(avg(x * x) + 1e-5) AS r FROM vectors GROUP BY vec_id)"],
            f"SELECT vec_id, dim, {_round('x / r')} AS value FROM vectors JOIN norms USING (vec_id)",
        ),
        "group_softmax": (
            f"SELECT vec_id, label, {_round('e / sum(e) OVER (PARTITION BY label)')} AS p FROM ("
            "SELECT vec_id, label, exp(s - max(s) OVER (PARTITION BY label)) AS e FROM ("
            "SELECT vec_id, label, list_sum(list_transform(embedding, lambda x: x::DOUBLE)) AS s FROM embeddings))"
        ),
        "attention_pool": _attention("a.vec_id <> b.vec_id"),
        "causal_pool": _attention("b.vec_id <= a.vec_id"),
        "cross_entropy": losses,
        "clip_l2_norm": _with(
            [_VECTORS, "s AS (SELECT least(1.0, 1.0 / (sqrt(sum(x * x)) + 1e-6)) AS c FROM vectors)"],
            f"SELECT vec_id, dim, {_round('x * c')} AS value FROM vectors, s",
        ),
        "stream_pretoken_counts": pretokens,
    }


ORACLES = _oracles()
