"""SQL counterparts of the corpus queries, in DuckDB's dialect, where SQL can express them."""

from __future__ import annotations

from timeward.llm import chat, mixing, outliers, treap_search

_BLANK = r"[\x20\x09-\x0D]"


def chat_sql(extra: str) -> str:
    """``extra`` is the text that both turns of conversation -7 say."""
    quoted = extra.replace("'", "''")
    guarded = "t"
    for found in ("\\", ":", "#"):
        guarded = f"replace({guarded}, '{found}', '\\{found}')"
    escaped = f"replace({guarded}, '{chat.END}', '<\\/turn>')"
    return rf"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
    UNION ALL SELECT -7, 0, 'user', '{quoted}'
    UNION ALL SELECT -7, 1, 'assistant', '{quoted}'
),
sized AS (
    SELECT *,
        contains(t, '{chat.END}') OR contains(role, '{chat.END}') OR contains(role, ':') OR contains(role, '\') AS guarded,
        length({escaped}) + length({escaped.replace("(t,", "(role,")}) + 1 AS escaped_size
    FROM rows
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
    coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum({len("### ") + len(": ") + len(chat.END) + 1}
        + CASE WHEN guarded THEN escaped_size ELSE length(role) + length(t) END)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


def _words(text: str) -> str:
    return rf"list_filter(string_split_regex(coalesce({text}, ''), '{_BLANK}+'), lambda w: w <> '')"


def mixing_sql(mix: mixing.Mix) -> str:
    """The least flattening that reaches the goals is found by trying every step of the exponent."""
    grid = mixing.GRID
    hash60 = lambda text: f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"
    turn = lambda number: hash60(f"'{mix.seed}:' || key || ':' || {number} || ':' || block")
    doc_id = "coalesce(':' || doc_id::VARCHAR, '')"
    return rf"""
WITH sized AS (
    SELECT doc_id, source, len({_words('text')})::BIGINT AS mix_tokens,
        CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS key,
        ({hash60(f"'{mix.seed}' || {doc_id}")} % {mix.blocks})::INTEGER AS block
    FROM documents
),
blocks AS (SELECT key, block, sum(mix_tokens)::BIGINT AS tokens FROM sized GROUP BY ALL),
every AS (SELECT key, sum(tokens)::BIGINT AS tokens FROM blocks GROUP BY ALL),
totals AS (SELECT *, tokens / (SELECT max(tokens) FROM every)::DOUBLE AS s FROM every WHERE tokens > 0),
tried AS (
    SELECT k, sum(pow(s, k / {grid}.0::DOUBLE)) AS z, sum(pow(s, k / {grid}.0::DOUBLE) * ln(s)) AS weighted,
        max(pow(s, k / {grid}.0::DOUBLE - 1)) AS passes, count(*) AS n
    FROM totals, (SELECT unnest(range(0, {grid + 1})) AS k) GROUP BY k
),
chosen AS (
    SELECT CASE WHEN (SELECT count(*) FROM totals) <= 1 THEN {grid} ELSE greatest(
        coalesce((SELECT max(k) FROM tried WHERE ln(z) - (k / {grid}.0::DOUBLE) * weighted / z >= {mix.entropy} * ln(n)), 0),
        coalesce((SELECT max(k) FROM tried WHERE passes > {mix.most_passes}), -1) + 1
    ) END AS k
),
planned AS (
    SELECT key, tokens, round(pow(s, k / {grid}.0::DOUBLE) * (SELECT max(tokens) FROM every))::BIGINT AS budget FROM totals, chosen
),
counted AS (SELECT key, tokens, (budget // tokens)::INTEGER AS passes, budget % tokens AS remaining FROM planned),
placed AS (
    SELECT b.key, b.block, b.tokens, c.remaining, {turn('c.passes').replace('key', 'b.key').replace('block', 'b.block')} AS place
    FROM blocks b JOIN counted c ON b.key = c.key WHERE c.remaining > 0
),
running AS (
    SELECT *, coalesce(sum(tokens) OVER (PARTITION BY key ORDER BY place, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM placed
),
cuts AS (SELECT key, max(place) AS cut FROM running WHERE before < remaining GROUP BY key),
plan AS (
    SELECT e.key, coalesce(c.passes, 1) AS passes, coalesce(u.cut, -1) AS cut
    FROM every e LEFT JOIN counted c ON e.key = c.key LEFT JOIN cuts u ON e.key = u.key
),
copied AS (
    SELECT d.doc_id, d.source, d.mix_tokens, d.key, d.block,
        unnest(range(0, p.passes + CASE WHEN {turn('p.passes').replace('key', 'd.key').replace('block', 'd.block')} <= p.cut THEN 1 ELSE 0 END)) AS number
    FROM sized d JOIN plan p ON d.key = p.key
)
SELECT doc_id, source, mix_tokens, number::INTEGER AS mix_pass, block AS mix_block, {turn('number')} AS mix_place FROM copied
"""


def outliers_sql() -> str:
    """The base statistics, and the estimate step by step as the operator takes it."""
    n, p = outliers, outliers.P
    axes = range(p)
    scale = lambda text: f"CAST(round({n.SCALE} * {text}) AS BIGINT)"
    xs = ", ".join(f"{scale(t)} AS x{k}" for k, t in enumerate(n.COORDINATES))
    roots = n._inverse_root({(i, j): f"c{i}{j}" for i, j in n._LOWER})

    def rooted(name: str, source: str) -> str:
        """Chain of steps, each using the columns before it."""
        steps, last = [], source
        for k, (column, text) in enumerate(roots):
            steps.append(f"{name}_{k} AS (SELECT *, {text} AS {column} FROM {last})")
            last = f"{name}_{k}"
        return ",\n".join([*steps, f"{name} AS MATERIALIZED (SELECT key, n, {', '.join(n._PARAMS)} FROM {last})"])

    def binned(name: str, params: str) -> str:
        sums = ", ".join(f"sum(x{k}) AS s{k}" for k in axes)
        products = ", ".join(f"sum(x{i} * x{j}) AS p{i}{j}" for i, j in n._LOWER)
        return f"""{name}_b AS (
    SELECT key, {n.distance_bin()} AS bin, count(*) AS k, {sums}, {products}
    FROM levels JOIN {params} USING (key) GROUP BY ALL
),
{name}_r AS MATERIALIZED (
    SELECT *, sum(k) OVER (PARTITION BY key ORDER BY bin ROWS UNBOUNDED PRECEDING) AS run, sum(k) OVER (PARTITION BY key) AS total
    FROM {name}_b
)"""

    ridge = float(n.FLOOR * n.FLOOR)
    parts = []
    for step in range(n.STEPS):
        cov = ", ".join(
            f"(p{i}{j} - s{i} * s{j} / h) / h{f' + {ridge}' if i == j else ''} AS c{i}{j}" for i, j in n._LOWER
        )
        parts += [
            binned(f"a{step}", f"e{step}"),
            f"""a{step}_t AS (
    SELECT key, max(total) AS n, sum(k)::DOUBLE AS h, {", ".join(f"sum(s{k})::DOUBLE AS s{k}" for k in axes)},
        {", ".join(f"sum(p{i}{j})::DOUBLE AS p{i}{j}" for i, j in n._LOWER)}
    FROM a{step}_r WHERE run - k < {n.SHARE}::DOUBLE * total GROUP BY key
),
a{step}_c AS (SELECT key, n, {", ".join(f"s{k} / h AS m{k}" for k in axes)}, {cov} FROM a{step}_t)""",
            rooted(f"e{step + 1}", f"a{step}_c"),
        ]
    start = ", ".join(
        f"{f'2.1981::DOUBLE * d{i} * d{i} + {ridge}' if i == j else '0.0::DOUBLE'} AS c{i}{j}" for i, j in n._LOWER
    )
    final = f"e{n.STEPS}"
    lines = "list_filter(string_split(t, chr(10)), lambda l: regexp_replace(l, '" + _BLANK + "', '', 'g') <> '')"
    windows = "list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])"
    pick = lambda level, key: f"LEFT JOIN fitted f{level} ON f{level}.key = {key}" + (
        f" AND f{level}.n >= {n.LEAST_ROWS}" if level < 2 else ""
    )
    chosen = ", ".join(f"coalesce(f0.{c}, f1.{c}, f2.{c}) AS {c}" for c in [*n._PARAMS, "factor"])
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
cut AS (SELECT *, {_words('t')} AS w FROM texts),
shingles AS (
    SELECT r, unnest({windows}) AS s, unnest(range(1, len(w) - 1)) AS i FROM cut WHERE len(w) >= 3
),
twice AS (SELECT r, i FROM shingles QUALIFY count(*) OVER (PARTITION BY r, s) > 1),
covered AS (SELECT r, count(DISTINCT i + o) AS c FROM twice, (SELECT unnest([0, 1, 2]) AS o) GROUP BY r),
counted AS (
    SELECT cut.r, doc_id, lang, source, len(w)::BIGINT AS n_words,
        length(regexp_replace(t, '{_BLANK}', '', 'g'))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len({lines}) - len(list_distinct({lines})))::BIGINT AS n_dup_lines,
        coalesce(c, 0)::BIGINT AS n_repeat_words
    FROM cut LEFT JOIN covered ON cut.r = covered.r
),
based AS MATERIALIZED (
    SELECT *, n_words < {n.LEAST_WORDS} OR 100 * n_repeat_words > {n.MOST_REPEATED} * n_words AS base_failed,
        '0' || to_json({{'l': lang, 's': source}}) AS key0, '1' || to_json({{'l': lang}}) AS key1, '2' AS key2
    FROM counted
),
vectors AS MATERIALIZED (SELECT r, key0, key1, key2, {xs} FROM based WHERE NOT base_failed),
levels AS MATERIALIZED (
    {" UNION ALL ".join(f"SELECT key{k} AS key, {', '.join(f'x{j}' for j in axes)} FROM vectors" for k in range(3))}
),
axes AS (
    {" UNION ALL ".join(f"SELECT key, {k} AS axis, x{k} AS value, count(*) AS k FROM levels GROUP BY ALL" for k in axes)}
),
middle AS MATERIALIZED (
    SELECT key, axis, min(value) AS middle, max(total) AS total FROM (
        SELECT *, sum(k) OVER (PARTITION BY key, axis ORDER BY value ROWS UNBOUNDED PRECEDING) AS run,
            sum(k) OVER (PARTITION BY key, axis) AS total FROM axes
    ) WHERE 2 * run >= total GROUP BY key, axis
),
offs AS (
    SELECT key, axis, abs(value - middle) AS off, sum(k) AS k FROM axes JOIN middle USING (key, axis) GROUP BY ALL
),
spread AS (
    SELECT key, axis, min(off) AS mad FROM (
        SELECT *, sum(k) OVER (PARTITION BY key, axis ORDER BY off ROWS UNBOUNDED PRECEDING) AS run,
            sum(k) OVER (PARTITION BY key, axis) AS total FROM offs
    ) WHERE 2 * run >= total GROUP BY key, axis
),
first AS (
    SELECT key, max(total) AS n, {", ".join(f"max(middle) FILTER (axis = {k})::DOUBLE AS m{k}" for k in axes)},
        {", ".join(f"max(mad) FILTER (axis = {k})::DOUBLE AS d{k}" for k in axes)}
    FROM middle JOIN spread USING (key, axis) GROUP BY key
),
started AS (SELECT key, n, {", ".join(f"m{k}" for k in axes)}, {start} FROM first),
{rooted("e0", "started")},
{("," + chr(10)).join(parts)},
{binned("z", final)},
factors AS (
    SELECT key, greatest((min(bin) + 0.5::DOUBLE) / {n._BINS} * ((min(bin) + 0.5::DOUBLE) / {n._BINS}) / {n.CHI_MEDIAN}::DOUBLE, 1.0) AS factor
    FROM z_r WHERE 2 * run >= total GROUP BY key
),
fitted AS MATERIALIZED (SELECT * FROM {final} JOIN factors USING (key)),
placed AS (
    SELECT v.*, {chosen} FROM vectors v {pick(0, "v.key0")} {pick(1, "v.key1")} {pick(2, "v.key2")}
),
judged AS (SELECT r, ({n.squared_distance()}) / factor <= {n.CUTOFF} AS inside FROM placed)
SELECT doc_id, {", ".join(n.STATS)}, base_failed, NOT base_failed AND coalesce(inside, true) AS kept
FROM based LEFT JOIN judged ON based.r = judged.r
"""


# CRC-32 of decimal digits, byte by byte and bit by bit.
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)), "
    "lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), list_transform(range(8), lambda b: b::BIGINT)), "
    "lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
)


def _fields(*names: str) -> str:
    parts = [f"CASE WHEN {n} IS NULL THEN '-' ELSE strlen(({n})::VARCHAR) || ':' || ({n})::VARCHAR END" for n in names]
    return f"sha256({' || '.join(parts)})"


def _tree(name: str, leaves: str, levels: int) -> str:
    """CTEs ``name_0`` to ``name_levels`` of nodes, a level at a time; a tree with one node left stays as it is."""
    parts = [f"{name}_0 AS MATERIALIZED (SELECT tree, rank AS pos, size AS n, digest FROM {leaves})"]
    for k in range(levels):
        parts.append(f"""{name}_{k + 1} AS MATERIALIZED (
    SELECT tree, pos // 2 AS pos, min((n + 1) // 2) AS n,
        CASE WHEN min(n) = 1 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
    FROM {name}_{k} GROUP BY tree, pos // 2
)""")
    return ",\n".join(parts)


def _climb(name: str, start: str, levels: int) -> str:
    """CTE ``name_up_levels``: every row of ``start`` (tree, rank, size, folded, proof) after the climb."""
    parts = [f"{name}_up_0 AS (SELECT * FROM {start})"]
    for k in range(levels):
        parts.append(f"""{name}_up_{k + 1} AS MATERIALIZED (
    SELECT u.* REPLACE (
        CASE WHEN s.n = 1 THEN folded
            WHEN (rank >> {k}) % 2 = 0 THEN sha256(folded || coalesce(o.digest, '')) ELSE sha256(o.digest || folded) END AS folded,
        proof || coalesce(CASE WHEN s.n > 1 THEN o.digest END, '') AS proof)
    FROM {name}_up_{k} u JOIN {name}_{k} s ON s.tree = u.tree AND s.pos = rank >> {k}
    LEFT JOIN {name}_{k} o ON o.tree = u.tree AND o.pos = xor(rank >> {k}, 1)
)""")
    return ",\n".join(parts)


def merkle_sql(levels: int = 24, upper_levels: int = 8) -> str:
    """Levels are written out: enough for 2^24 documents of a language and 2^8 languages."""
    return f"""
WITH leaves AS MATERIALIZED (
    SELECT doc_id, CASE WHEN lang IS NULL THEN '0' ELSE '1' || lang END AS tree,
        {_fields("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
        CASE WHEN {_CRC.format("doc_id::VARCHAR")} % 7 = 0
            THEN {_fields("doc_id", "source", "lang", "n_chars + 1", "text")}
            ELSE {_fields("doc_id", "source", "lang", "n_chars", "text")} END AS tampered
    FROM documents
),
placed AS MATERIALIZED (
    SELECT *, leaf AS digest, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
        count(*) OVER (PARTITION BY tree) AS size
    FROM leaves
),
{_tree("low", "placed", levels)},
subroots AS MATERIALIZED (
    SELECT '' AS tree, tree AS name, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS rank, count(*) OVER () AS size
    FROM low_{levels}
),
{_tree("high", "subroots", upper_levels)},
low_start AS (SELECT *, tampered AS folded, '' AS proof FROM placed),
{_climb("low", "low_start", levels)},
high_start AS (
    SELECT s.tree, s.rank, s.size, s.digest AS subroot, u.doc_id, u.leaf, u.folded, u.proof
    FROM low_up_{levels} u JOIN subroots s ON s.name = u.tree
),
{_climb("high", "high_start", upper_levels)}
SELECT doc_id, leaf, subroot, r.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.digest AS verified
FROM high_up_{upper_levels} CROSS JOIN high_{upper_levels} r
"""


def search_sql(k: int = 20) -> str:
    term = treap_search.TERM
    lower = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    cut = f"unnest(regexp_extract_all({lower.format('text')}, '{term}'))"
    return f"""
WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
words AS MATERIALIZED (SELECT r, {cut} AS term FROM numbered),
sizes AS (SELECT r, count(*) AS n FROM words GROUP BY r),
whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
asked AS (SELECT item_id, term, count(*) AS repeats FROM (SELECT item_id, {cut} AS term FROM benchmark) GROUP BY ALL),
postings AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
    SELECT term, floor(1000 * ln((2 * max(n_docs) + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM postings CROSS JOIN whole GROUP BY term
),
scored AS (
    SELECT item_id, r, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN sizes USING (r) CROSS JOIN whole GROUP BY ALL
),
placed AS (
    SELECT item_id, doc_id, score,
        row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank
    FROM scored JOIN numbered USING (r) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= {k}
"""
