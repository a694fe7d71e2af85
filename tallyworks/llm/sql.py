"""The registered queries as DuckDB SQL, where SQL can say them."""

from __future__ import annotations

from tallyworks.llm.chat import MARK
from tallyworks.llm.licenses import TEMPLATES, Template
from tallyworks.llm.mixing import SLOPES, WEIGHTS
from tallyworks.llm.sharding import BITS, LIMIT
from tallyworks.llm.strata import K as RANKS
from tallyworks.llm.topk_search import EVERY, SCALE, K

KEY = "substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 16)"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def op3() -> str:
    def places(t: Template) -> str:
        key = t.key_words
        stands = " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(key))
        return f"list_filter(range(greatest(len(w) - {len(key) - 1}, 0)), lambda i: {stands})"

    def share(n: int, t: Template) -> str:
        if t.base:
            return f"CASE WHEN len(p{n}) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
        agree = " + ".join(
            f"CASE WHEN s - {t.key_at} + {k} >= 0 AND coalesce(w[s - {t.key_at} + {k + 1}], '') = '{x}' THEN 1 ELSE 0 END"
            for k, x in enumerate(t.all_words))
        return f"coalesce(list_max(list_transform(p{n}, lambda s: ({agree}) / {len(t.all_words)}::DOUBLE)), 0.0::DOUBLE)"

    def names(picked: list[tuple[int, Template]]) -> str:
        held = ", ".join(f"CASE WHEN len(p{n}) > 0 THEN '{t.label}' END" for n, t in picked)
        return (f"coalesce(array_to_string(list_sort(list_distinct(list_filter([{held}], lambda x: x IS NOT NULL))), ','), '')")

    numbered = list(enumerate(TEMPLATES))
    firm = [(n, t) for n, t in numbered if t.base]
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    every = "list_concat(" * (len(firm) - 1) + f"p{firm[0][0]}" + "".join(f", p{n})" for n, _ in firm[1:])
    return f"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
p AS (SELECT doc_id, w, {', '.join(f'{places(t)} AS p{n}' for n, t in numbered)} FROM t)
SELECT doc_id, len(w)::BIGINT AS n_words, len({every})::BIGINT AS n_base,
    list_min({every})::BIGINT AS first_word, list_max({every})::BIGINT AS last_word,
    {names(firm)} AS base_labels, {names(numbered)} AS labels,
    greatest({', '.join(share(n, t) for n, t in numbered)}) AS score
FROM p"""


def op6() -> str:
    """Without the parts of rows that share all bits, which whole tables of distinct ids don't have."""
    return f"""
WITH t AS (SELECT doc_id, ('0x' || substr({KEY}, 1, {BITS // 4}))::BIGINT AS h,
    strlen(coalesce(text, ''))::BIGINT AS n_bytes FROM documents),
s AS (SELECT d.d, h >> ({BITS} - d.d) AS bucket, sum(n_bytes)::BIGINT AS shard_bytes
    FROM t, (SELECT unnest(range({BITS // 2})) AS d) AS d GROUP BY ALL),
f AS (SELECT t.doc_id, t.h, t.n_bytes, min(s.d) AS depth
    FROM t JOIN s ON t.h >> ({BITS} - s.d) = s.bucket AND s.shard_bytes <= {LIMIT} GROUP BY ALL)
SELECT f.doc_id, f.n_bytes, f.depth || '-' || s.bucket || '-0' AS shard, f.depth::INT AS depth, s.shard_bytes
FROM f JOIN s ON s.d = f.depth AND s.bucket = f.h >> ({BITS} - f.depth)"""


OP7 = """
WITH t AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
w AS (SELECT doc_id, unnest(range(len(l) - 2)) AS s, l FROM t WHERE len(l) >= 3),
o AS (SELECT doc_id, s, l[s + 1] AS a, l[s + 2] AS b, l[s + 3] AS c FROM w),
r AS (SELECT doc_id, s, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id NULLS LAST, s) AS nth
    FROM o WHERE trim(a || b || c, ' ') <> ''),
g AS (SELECT doc_id, list_sort(list_distinct(flatten(list([s, s + 1, s + 2])))) AS gone FROM r WHERE nth > 1 GROUP BY doc_id)
SELECT t.doc_id, CASE WHEN gone IS NULL THEN text ELSE array_to_string(
        list_transform(list_filter(range(len(l)), lambda i: NOT list_contains(gone, i)), lambda i: l[i + 1]), chr(10)) END AS text,
    coalesce(len(l), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed
FROM t LEFT JOIN g USING (doc_id)"""


def op9() -> str:
    weights, slopes = list(WEIGHTS), list(SLOPES)
    place = "greatest(least(goal - begun - e * source_size, size), 0)"
    return f"""
WITH d AS (SELECT doc_id, source, {KEY} AS key,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS nth FROM d GROUP BY source),
r AS (SELECT *, ({weights})[(nth - 1) % {len(weights)} + 1] AS weight, ({slopes})[(nth - 1) % {len(slopes)} + 1]::DOUBLE AS slope, 3 * source_size AS most FROM s),
l AS (SELECT *, sum(source_size) OVER () - sum(most) OVER (ORDER BY most / weight, nth) + most AS rest,
    sum(weight) OVER (ORDER BY most / weight DESC, nth DESC) AS sharing, row_number() OVER (ORDER BY most / weight, nth) AS place FROM r),
v AS (SELECT rest, sharing FROM l WHERE NOT rest * weight > most * sharing ORDER BY place LIMIT 1),
g AS (SELECT l.source, l.source_size, l.slope, CASE WHEN l.rest * l.weight > l.most * l.sharing THEN l.most::DOUBLE
    ELSE (l.weight * v.rest)::DOUBLE / v.sharing::DOUBLE END AS target FROM l, v),
p AS (SELECT d.doc_id, d.size, g.source_size, g.slope, g.target, floor(g.target + 0.5)::BIGINT AS goal,
    (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS begun
    FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
q AS (SELECT *, list_filter(range(3), lambda e: {place} > 0) AS epochs, least(begun / target, 1.0) AS done FROM p)
SELECT doc_id, size, source_size, target, list_sum(list_transform(range(3), lambda e: {place}))::BIGINT AS taken,
    len(epochs)::INT AS n_epochs, round(CASE WHEN len(epochs) = 0 THEN NULL WHEN slope = 0 THEN done
    ELSE 2 * done / ((1 - slope) + sqrt((1 - slope) * (1 - slope) + 4 * slope * done)) END, 9) AS first_time
FROM q"""


def op8() -> str:
    return f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS x FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v AS q JOIN v AS c ON q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= {K}"""


def op12() -> str:
    """A turn is escaped, mark by mark, where it holds a control string or what reads as an escape."""
    control = r"</?s>|\[/?INST\]"

    def length(c: str) -> str:
        more = f"len({c}) - len(replace({c}, '{MARK}', '')) + len(regexp_extract_all({c}, '{control}'))"
        return f"len({c}) + CASE WHEN conflict THEN {more} ELSE 0 END"

    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
c AS (SELECT *, regexp_matches(role || ' ' || text, '{control}|{MARK}[0-3]') AS conflict FROM t),
r AS (SELECT *, CASE WHEN role = 'assistant' THEN 7 + {length("text")} ELSE 14 + {length("role")} + {length("text")} END AS size FROM c),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss, sum(size)::BIGINT AS size
    FROM r GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, len(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
    size AS formatted_chars FROM g"""


def op13() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def terms(table: str, key: str) -> str:
        return (f"SELECT {key}, unnest(regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), "
                f"'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS term FROM {table}")

    return f"""
WITH o AS ({terms("documents", "doc_id")}),
f AS (SELECT doc_id, term, count(*) AS tf FROM o GROUP BY ALL),
l AS (SELECT doc_id, sum(tf)::HUGEINT AS n FROM f GROUP BY doc_id),
s AS (SELECT count(*)::HUGEINT AS docs, sum(n)::HUGEINT AS terms FROM l),
m AS (SELECT doc_id, (75 + (25 * n * docs) // terms)::BIGINT AS m FROM l, s),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM f, s GROUP BY term, docs),
q AS (SELECT item_id, term, count(*) AS times FROM ({terms("benchmark", "item_id")}) GROUP BY ALL),
p AS (SELECT item_id, f.doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM q JOIN w USING (term) JOIN f USING (term) JOIN m ON m.doc_id = f.doc_id GROUP BY ALL),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM p WHERE score > 0)
SELECT * FROM r WHERE rank <= {RANKS}"""


def oracle() -> dict[str, str]:
    return {"op3_license_scan": op3(), "op6_sharding": op6(), "op7_line_dedup": OP7, "op8_topk_search": op8(),
            "op9_mixing": op9(), "op12_chat_format": op12(), "op13_lexical_rank": op13()}
