"""SQL with the same result as the queries that SQL can express."""

from __future__ import annotations

from faultline.llm import merkle, mixing, ngram_join, warc
from faultline.llm.vector_rows import K, QUERY_STEP

# Rounds written out in SQL: more than the tables need for raking and level to settle.
RAKE_ROUNDS, LEVEL_ROUNDS = 24, 12


def _case(column: str, table: dict[str, float], other: float) -> str:
    whens = " ".join(f"WHEN '{value}' THEN CAST({share} AS DOUBLE)" for value, share in table.items())
    return f"CASE {column} {whens} ELSE CAST({other} AS DOUBLE) END"


def mixing_sql() -> str:
    """Raking with all rounds written out, the level of the budget, and copies from the weights alone."""
    steps = [
        r"""
counted AS (
  SELECT doc_id, source, lang, coalesce(text, '') AS text,
         len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+'))::BIGINT AS n_tokens
  FROM documents),
docs AS (
  SELECT *, CASE WHEN length(text) / greatest(n_tokens, 1) < 5.5 THEN 'short'
                 WHEN length(text) / greatest(n_tokens, 1) < 6.5 THEN 'medium' ELSE 'long' END AS topic
  FROM counted),
cells AS (
  SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM docs GROUP BY ALL HAVING sum(n_tokens) > 0)"""
    ]
    shares = {
        "source": f"pow(sum(tokens), {mixing.SOURCE_POWER})",
        "lang": _case("lang", mixing.LANGUAGE_TARGETS, mixing.OTHER),
        "topic": _case("topic", mixing.TOPIC_TARGETS, mixing.OTHER),
    }
    for margin, share in shares.items():
        steps.append(
            f"{margin}s AS (SELECT {margin}, raw / sum(raw) OVER () * sum(tokens) OVER () AS {margin}_target"
            f" FROM (SELECT {margin}, {share} AS raw, sum(tokens) AS tokens FROM cells GROUP BY {margin}))"
        )
    joins = " ".join(f"JOIN {m}s ON cells.{m} IS NOT DISTINCT FROM {m}s.{m}" for m in mixing.MARGINS)
    targets = ", ".join(f"{m}_target" for m in mixing.MARGINS)
    steps.append(
        f"w0 AS (SELECT cells.source, cells.lang, cells.topic, tokens, {targets}, CAST(1 AS DOUBLE) AS weight FROM cells {joins})"
    )
    step = 0
    for _ in range(RAKE_ROUNDS):
        for margin in mixing.MARGINS:
            steps.append(
                f"w{step + 1} AS MATERIALIZED (SELECT source, lang, topic, tokens, {targets}, weight *"
                f" ({margin}_target / sum(weight * tokens) OVER (PARTITION BY {margin})) AS weight FROM w{step})"
            )
            step += 1
    last = f"w{step}"
    steps.append(
        f"f0 AS (SELECT {mixing.RATE} * sum(tokens) / sum(weight * tokens) AS factor, {mixing.RATE} * sum(tokens) AS budget FROM {last})"
    )
    for i in range(LEVEL_ROUNDS):
        full = f"coalesce(sum(tokens) FILTER (weight * factor >= 1), 0)"
        rest = f"coalesce(sum(weight * tokens) FILTER (weight * factor < 1), 0)"
        steps.append(
            f"f{i + 1} AS MATERIALIZED (SELECT CASE WHEN {rest} > 0 AND any_value(budget) > {full}"
            f" THEN (any_value(budget) - {full}) / {rest} ELSE any_value(factor) END AS factor, any_value(budget) AS budget"
            f" FROM {last}, f{i})"
        )
    draw = f"CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13) AS BIGINT) / 4503599627370496.0"
    return f"""
WITH {', '.join(steps)},
placed AS (
  SELECT d.doc_id, d.source, d.lang, d.topic, d.n_tokens, coalesce(w.weight, 0) AS weight,
         least(1.0, coalesce(w.weight, 0) * (SELECT factor FROM f{LEVEL_ROUNDS})) AS p,
         coalesce(w.weight, 0) * (SELECT factor FROM f0) AS e, {draw} AS u
  FROM docs d LEFT JOIN {last} w ON d.source IS NOT DISTINCT FROM w.source
    AND d.lang IS NOT DISTINCT FROM w.lang AND d.topic = w.topic)
SELECT doc_id, source, lang, topic, n_tokens, round(weight, 6) AS weight, round(p, 6) AS probability,
       u < p AS drawn, round(e, 6) AS expected_copies,
       CAST(floor(e) + CASE WHEN u < e - floor(e) THEN 1 ELSE 0 END AS INTEGER) AS copies
FROM placed"""


WARC_SQL = rf"""
WITH p AS (
  SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT *, array_to_string(list_transform(range(32), lambda i:
           substr('{warc.BASE32}', (CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT)
             >> CAST(15 - 5 * (i % 4) AS INTEGER)) % 32 + 1, 1)), '') AS payload_digest,
         min(page_id) OVER (PARTITION BY hex) AS original
  FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to,
       regexp_replace(url, '[\x00-\x20\x7f]', '%20', 'g') AS url
FROM d"""

PRODUCTS_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % {QUERY_STEP} = 0 AND q.vec_id <> c.vec_id),
placed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= {K}"""

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NGRAM_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_CAPITALS}', '{_CAPITALS.lower()}'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
g AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] ELSE list_distinct(list_transform(
           range(greatest(len(words) - {ngram_join.SHINGLE - 1}, 1)),
           lambda i: array_to_string(words[i + 1 : i + {ngram_join.SHINGLE}], ' '))) END AS grams
  FROM w),
s AS (SELECT doc_id, len(grams)::BIGINT AS n, unnest(grams) AS gram FROM g),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS both_have
  FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM common WHERE 100 * both_have >= {ngram_join.PERCENT} * (na + nb - both_have)),
ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT a, b FROM ways UNION SELECT r.a, w.b FROM reach r JOIN ways w ON r.b = w.a)
SELECT g.doc_id, len(g.grams)::BIGINT AS n_shingles, least(g.doc_id, coalesce(min(r.b), g.doc_id)) AS component_id
FROM g LEFT JOIN reach r ON r.a = g.doc_id GROUP BY g.doc_id, g.grams"""


MERKLE_LEVELS, MERKLE_TREE_LEVELS = 8, 4  # enough for 8 ** 8 rows of a language and 8 ** 4 languages


def merkle_sql() -> str:
    """All levels written out; levels above a tree's top repeat it."""

    def field(value: str) -> str:
        return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(field(text if f == 'text' else f) for f in merkle.FIELDS)})"

    def climb(name: str, level: int, tree: str) -> str:
        return (
            f"{name}r{level} AS MATERIALIZED (SELECT {tree}, pos // {merkle.ARITY} AS run, any_value(n) AS n,"
            f" list(node ORDER BY pos) AS nodes FROM {name}{level} GROUP BY ALL),"
            f"{name}{level + 1} AS MATERIALIZED (SELECT {tree}, run AS pos, (n + {merkle.ARITY - 1}) // {merkle.ARITY} AS n,"
            f" CASE WHEN n > 1 THEN sha256(array_to_string(nodes, '')) ELSE nodes[1] END AS node FROM {name}r{level})"
        )

    lower = f"translate(text, '{_CAPITALS}', '{_CAPITALS.lower()}')"
    bits = "flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: list_transform(range(8), lambda i: (ord(c) >> i::INTEGER) & 1)))"
    crc = f"""xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}::BIGINT[]),
      lambda c, b: CASE WHEN xor(c, b) & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END), 4294967295::BIGINT)"""
    steps = [
        f"""
leaves AS MATERIALIZED (
  SELECT doc_id, coalesce('1' || lang, '0') AS tree, {leaf('text')} AS node,
         CASE WHEN doc_id IS NOT NULL AND text IS NOT NULL AND {crc} % {merkle.TAMPERED} = 0 THEN {leaf(lower)}
              ELSE {leaf('text')} END AS changed
  FROM documents),
l0 AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, node) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n FROM leaves)"""
    ]
    steps += [climb("l", i, "tree") for i in range(MERKLE_LEVELS)]
    steps.append(
        f"t0 AS MATERIALIZED (SELECT tree, node, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n"
        f" FROM l{MERKLE_LEVELS})"
    )
    steps += [climb("t", i, "1 AS one" if not i else "one") for i in range(MERKLE_TREE_LEVELS)]
    steps.append(
        f"p0 AS (SELECT l0.doc_id, l0.tree, l0.node AS leaf, t0.node AS subroot, t{MERKLE_TREE_LEVELS}.node AS root, l0.pos AS place,"
        f" t0.pos AS tree_place, changed AS fold, '' AS proof FROM l0 JOIN t0 USING (tree), t{MERKLE_TREE_LEVELS})"
    )
    step = 0
    for name, count, at, on in (("l", MERKLE_LEVELS, "place", "p.tree = r.tree AND"), ("t", MERKLE_TREE_LEVELS, "tree_place", "")):
        for level in range(count):
            own = f"p.{at} % {merkle.ARITY} + 1"
            before, after = f"r.nodes[1 : ({own}) - 1]", f"r.nodes[({own}) + 1 : {merkle.ARITY}]"
            joined = [f"array_to_string({part}, '')" for part in (before, after)]
            steps.append(
                f"p{step + 1} AS MATERIALIZED (SELECT p.* EXCLUDE (fold, proof, {at}), p.{at} // {merkle.ARITY} AS {at},"
                f" CASE WHEN r.n > 1 THEN sha256({joined[0]} || p.fold || {joined[1]}) ELSE p.fold END AS fold,"
                f" CASE WHEN r.n > 1 THEN p.proof || {joined[0]} || {joined[1]} ELSE p.proof END AS proof"
                f" FROM p{step} p JOIN {name}r{level} r ON {on} p.{at} // {merkle.ARITY} = r.run)"
            )
            step += 1
    return f"""
WITH {', '.join(steps)}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = root AS verified FROM p{step}"""


SQL = {
    "op1_mix_sources": mixing_sql(),
    "op3_warc_revisits": WARC_SQL,
    "op5_top_products": PRODUCTS_SQL,
    "op6_ngram_join": NGRAM_SQL,
    "op12_merkle_manifest": merkle_sql(),
}
