"""The registered queries of the operators, and the SQL of those it can express."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drivesync.llm import (
    decontam, hardneg, jaccardjoin, langid, linededup, merkle, neardup, packing, pii, secrets, sharding, suffixes, vectorcodes, vectors)

TOKENIZER = "word_bpe_49k.json"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_packing(spark, sf_dir):
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path())


def op2_fingerprints(spark, sf_dir):
    return merkle.fingerprint_documents(documents(spark, sf_dir))


def op3_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return langid.identify(docs.select("doc_id", "text"), langid.fit(docs)).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def op4_line_dedup(spark, sf_dir):
    return linededup.drop_boilerplate(documents(spark, sf_dir), report=True)


def op5_pii(spark, sf_dir):
    return pii.find_personal(documents(spark, sf_dir))


def op6_suffix_dedup(spark, sf_dir):
    return suffixes.remove_repeats(documents(spark, sf_dir))


def op7_decontamination(spark, sf_dir):
    return decontam.contaminations(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_secrets(spark, sf_dir):
    return secrets.find_secrets(documents(spark, sf_dir))


def op9_sharding(spark, sf_dir):
    return sharding.assign(documents(spark, sf_dir))


def op10_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(documents(spark, sf_dir), percent=85).select(
        "doc_id", "n_shingles", "component_id", "kept")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op11_hard_negatives(spark, sf_dir):
    return hardneg.hard_negatives(embeddings(spark, sf_dir))


def op12_jaccard_join(spark, sf_dir):
    return jaccardjoin.jaccard_join(documents(spark, sf_dir), percent=jaccardjoin.PERCENT, width=jaccardjoin.WIDTH)


def op13_vector_codes(spark, sf_dir):
    return vectorcodes.compress(embeddings(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_fingerprints, op3_language_id, op4_line_dedup, op5_pii, op6_suffix_dedup, op7_decontamination,
    op8_secrets, op9_sharding, op10_near_duplicates, op11_hard_negatives, op12_jaccard_join, op13_vector_codes)}


def _fingerprint(text: str) -> str:
    """SQL of a fingerprint; subqueries so that each level is named once."""
    leaf = merkle.LEAF.replace("\\\\", "\\")
    section = merkle.SECTION.replace("*+", "*").replace("++", "+")
    paragraphs = f"list_transform(regexp_extract_all({text}, '{merkle.PARAGRAPH}', 0), lambda p: list_transform(regexp_extract_all(p, '{leaf}', 0), lambda l: md5(l)))"
    digests = f"coalesce(array_to_string(list_transform({paragraphs}, lambda p: md5(array_to_string(p, '')) || ','), ''), '')"
    sections = f"list_transform(regexp_extract_all({digests}, '{section}', 0), lambda s: md5(s))"
    return f"""sha256(coalesce(array_to_string({sections}, ''), '')) || '|' ||
        coalesce(array_to_string(list_transform({sections}, lambda s: s[1:{merkle.SHORT}]), '.'), '') || '|' ||
        coalesce(array_to_string(list_transform({paragraphs}, lambda p: array_to_string(list_transform(p, lambda l: l[1:{merkle.SHORT}]), '')), ','), '')"""


def _likeness(a: str, b: str) -> str:
    leaves = lambda f: f"list_distinct(regexp_extract_all(split_part({f}, '|', 3), '[0-9a-f]{{{merkle.SHORT}}}', 0))"
    return f"""CASE WHEN split_part({a}, '|', 1) = split_part({b}, '|', 1) THEN 1.0::DOUBLE ELSE
        2.0::DOUBLE * len(list_intersect({leaves(a)}, {leaves(b)})) / (len({leaves(a)}) + len({leaves(b)})) END"""


def _secret_spans() -> str:
    parts = []
    for rank, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace("'", "''").replace("}+", "}")
        hits, between = f"regexp_extract_all(t, '{pattern}', 0)", f"regexp_split_to_array(t, '{pattern}')"
        lengths = lambda items, to: f"coalesce(list_sum(list_transform(list_slice({items}, 1, {to}), lambda x: length(x))), 0)"
        group, least = rule.least
        size = f"length(regexp_extract(h, '^{pattern}$', {group})) >= {least}" if group else "true"
        parts.append(f"""list_filter(list_transform({hits}, lambda h, i: {{'start': {lengths(between, 'i')} + {lengths(hits, 'i - 1')},
            'rank': {rank}, 'end': {lengths(between, 'i')} + {lengths(hits, 'i')}, 'kind': '{rule.name}', 'ok': {size}}}), lambda s: s.ok)""")
    return "list_sort(flatten([" + ", ".join(parts) + "]))"


def _joined(spans: str) -> str:
    return f"coalesce(array_to_string(list_transform({spans}, lambda s: s.kind || ':' || s.start || ':' || s.\"end\"), ','), '')"


def _bare(line: str) -> str:
    """SQL of a line without white space at its ends."""
    return f"trim({line}, {' || '.join(f'chr({ord(c)})' for c in linededup.WHITE)})"


def _vectors(scale: int, parts: int) -> str:
    """CTEs up to ``v``: rows that take part, with whole numbers ``x`` and a number ``r`` of their own."""
    limit = vectors.LIMIT
    return f"""f AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
        u AS (SELECT *, row_number() OVER () AS r FROM f WHERE len(e) > 0 AND len(e) % {parts} = 0
              AND len(list_filter(e, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        v AS MATERIALIZED (SELECT r, vec_id, label, e, list_transform(e, lambda c: greatest(least(floor(c * {scale}), {limit}), -{limit})) AS x FROM u
              WHERE len(e) = (SELECT len(e) FROM u ORDER BY vec_id IS NULL, vec_id, len(e) LIMIT 1))"""


def _hard_negatives() -> str:
    return f"""WITH {_vectors(hardneg.SCALE, 1)},
        n AS MATERIALIZED (SELECT r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, x FROM v
              WHERE vec_id IS NOT NULL AND label IS NOT NULL),
        s AS MATERIALIZED (SELECT a.r AS anchor, a.vec_id AS anchor_id, n.vec_id AS other, a.label = n.label AS same,
              list_inner_product(a.x, n.x)::BIGINT AS score
              FROM (SELECT min(r) AS r, vec_id, label, x FROM n WHERE vec_id % 50 = 0 GROUP BY vec_id, label, x) a JOIN n ON a.r <> n.r),
        p AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) AS place FROM s WHERE same),
        g AS (SELECT p.anchor, p.anchor_id, p.place, p.other AS positive_id, p.score AS positive_score, s.other AS negative_id,
              s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY s.score DESC, s.other) AS rank
              FROM p JOIN s ON p.anchor = s.anchor WHERE p.place <= 5 AND NOT s.same
              AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
        SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM g WHERE rank <= 3"""


def _jaccard_join() -> str:
    width, percent = jaccardjoin.WIDTH, jaccardjoin.PERCENT
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        d AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
              ELSE list_distinct(list_transform(range(1, len(w) - {width - 2}), lambda i: array_to_string(w[i:i + {width - 1}], ' '))) END AS s FROM w),
        g AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM d),
        l AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id
              AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
              GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
        r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT l.b, r.c FROM r JOIN l ON r.doc_id = l.a)
        SELECT d.doc_id, len(s)::BIGINT AS n_shingles, (SELECT min(c) FROM r WHERE r.doc_id = d.doc_id) AS component_id FROM d"""


def _vector_codes() -> str:
    parts, entries = vectorcodes.PARTS, vectorcodes.ENTRIES
    steps = []
    for step in range(vectorcodes.ROUNDS + 1):
        steps.append(f"""a{step} AS MATERIALIZED (SELECT r, p.part, min({{'d': (p.q - 2 * list_inner_product(p.x, b.x) + b.q)::BIGINT, 'e': b.entry}}) AS best
            FROM p JOIN b{step} b ON p.part = b.part GROUP BY r, p.part)""")
        if step < vectorcodes.ROUNDS:
            steps.append(f"""t{step} AS (SELECT part, entry, list(c ORDER BY i) AS x FROM (
                SELECT part, entry, i, floor(sum(c) / count(*)) AS c FROM (
                    SELECT p.part, a.best.e AS entry, unnest(p.x) AS c, generate_subscripts(p.x, 1) AS i FROM p JOIN a{step} a ON p.r = a.r AND p.part = a.part)
                GROUP BY part, entry, i) GROUP BY part, entry)""")
            steps.append(f"""b{step + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(t.x, b.x) AS x, list_inner_product(coalesce(t.x, b.x), coalesce(t.x, b.x)) AS q
                FROM b{step} b LEFT JOIN t{step} t ON b.part = t.part AND b.entry = t.entry)""")
    last = vectorcodes.ROUNDS
    return f"""WITH {_vectors(vectorcodes.SCALE, parts)},
        p AS MATERIALIZED (SELECT r, part, x[part * w + 1:(part + 1) * w] AS x, list_inner_product(x[part * w + 1:(part + 1) * w], x[part * w + 1:(part + 1) * w]) AS q
              FROM (SELECT r, x, len(x) // {parts} AS w, unnest(range({parts})) AS part FROM v)),
        o AS (SELECT r, row_number() OVER (ORDER BY vec_id IS NULL, vec_id, e) - 1 AS entry FROM v),
        b0 AS MATERIALIZED (SELECT part, entry, x, q FROM p JOIN o ON p.r = o.r WHERE entry < {entries}),
        {', '.join(steps)},
        h AS (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda c: c::BIGINT), ','), ',' ORDER BY part, entry)) AS h FROM b{last}),
        c AS (SELECT r, string_agg(lower(printf('%02x', best.e::BIGINT)), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a{last} GROUP BY r)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
        FROM c JOIN v ON c.r = v.r CROSS JOIN h"""


SQL = {
    "op2_fingerprints": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id DESC, text DESC) AS k FROM documents),
        n AS (SELECT a.doc_id, a.text, b.text AS other, length(a.text) AS n FROM d a
              JOIN d b ON b.k = CASE WHEN a.k = (SELECT max(k) FROM d) THEN 1 ELSE a.k + 1 END),
        e AS (SELECT doc_id, n, text, other, left(text, n - n // 2) || left(other, n // 2) AS edited FROM n),
        f AS (SELECT doc_id, n, edited, {_fingerprint('text')} AS fp, {_fingerprint('edited')} AS ep, {_fingerprint('other')} AS np FROM e)
        SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, fp AS fingerprint, ep AS edited_fingerprint,
            {_likeness('fp', 'ep')} AS near_edited, {_likeness('fp', 'np')} AS near_next FROM f""",
    "op4_line_dedup": f"""
        WITH p AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
        l AS (SELECT source, unnest(list_distinct(list_transform(lines, lambda x: {_bare('x')}))) AS line FROM p),
        t AS (SELECT source, count(*) AS pages FROM p GROUP BY source),
        b AS (SELECT l.source, list(line) AS drop FROM (
                SELECT source, line, count(*) AS n FROM l WHERE line <> '' GROUP BY source, line) l
              JOIN t ON l.source IS NOT DISTINCT FROM t.source
              WHERE n >= {linededup.LINE_PAGES} AND n > pages * {linededup.RATIO} GROUP BY l.source),
        k AS (SELECT p.*, list_filter(lines, lambda x: {_bare('x')} = '' OR NOT list_contains(coalesce(drop, []), {_bare('x')})) AS left_
              FROM p LEFT JOIN b ON p.source IS NOT DISTINCT FROM b.source),
        c AS (SELECT *, CASE WHEN len(list_filter(left_, lambda x: {_bare('x')} <> '')) > 0 THEN left_ ELSE lines END AS kept FROM k)
        SELECT doc_id, coalesce(len(lines), 0) AS n_lines, coalesce(len(lines) - len(kept), 0) AS n_dropped,
            sha256(array_to_string(kept, chr(10))) AS kept_sha256, coalesce(len(lines) - len(left_), 0) AS n_boilerplate FROM c""",
    "op8_secrets": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), s AS (SELECT doc_id, {_secret_spans()} AS found FROM d)
        SELECT doc_id, len(list_filter(found, lambda s: s.kind = 'assign')) AS n_assign,
            len(list_filter(found, lambda s: s.kind = 'access')) AS n_access, len(list_filter(found, lambda s: s.kind = 'hex')) AS n_hex,
            sha256({_joined("list_filter(found, lambda s: s.kind IN ('assign', 'access', 'hex'))")}) AS base_sha256,
            {_joined('found')} AS spans FROM s""",
    "op11_hard_negatives": _hard_negatives(),
    "op12_jaccard_join": _jaccard_join(),
    "op13_vector_codes": _vector_codes(),
}
