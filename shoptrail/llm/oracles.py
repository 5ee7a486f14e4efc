"""SQL for the registered queries that SQL can state."""

from shoptrail.llm import decontaminate, mixing, near_dups
from shoptrail.llm.common import LOWER, UPPER

_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+')"


def near_duplicates(shingle: int, percent: int = near_dups.PERCENT) -> str:
    """All pairs that share a shingle, and the smallest id reachable over links."""
    return f"""
    WITH RECURSIVE texts AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    sets AS (
      SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {shingle} THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - {shingle} + 2), lambda i: array_to_string(w[i:i + {shingle - 1}], ' '))) END AS s
      FROM texts),
    members AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
    links AS (
      SELECT a.doc_id AS a, b.doc_id AS b FROM members a JOIN members b ON a.g = b.g AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
    ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT ways.b, r FROM reach JOIN ways ON ways.a = reach.doc_id),
    found AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
    SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM sets JOIN found USING (doc_id)"""


def mix(weights=mixing.WEIGHTS, most: int = mixing.MOST_REPEATS) -> str:
    """Each source's documents in order of hash, against its budget."""
    listed = ", ".join(f"CAST({w} AS DOUBLE)" for w in weights)
    return f"""
    WITH sized AS (
      SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
        CAST(concat('0x', substr(md5(concat('mix:', CAST(doc_id AS VARCHAR))), 1, 15)) AS BIGINT) AS place FROM documents),
    totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
    weighed AS (
      SELECT *, CAST({most} * source_size AS DOUBLE) AS most, [{listed}][(number - 1) % {len(weights)} + 1] AS weight
      FROM (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS number FROM totals)),
    levels AS (
      SELECT *, most / weight AS fill,
        (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(most) OVER (ORDER BY most / weight, number
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY most / weight, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM weighed),
    targets AS (
      SELECT source, source_size,
        least(most, coalesce((SELECT level FROM levels WHERE fill > level ORDER BY fill, number LIMIT 1) * weight, most)) AS target
      FROM levels),
    budgets AS (
      SELECT *, target - repeats * source_size AS rest FROM (
        SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), {most}) ELSE 0 END AS repeats FROM targets)),
    places AS (SELECT source, place, sum(size) AS here FROM sized GROUP BY source, place),
    runs AS (
      SELECT *, coalesce(sum(here) OVER (PARTITION BY source ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM places)
    SELECT s.doc_id, s.size, b.source_size, b.target, CAST(s.size * (b.repeats + CASE WHEN r.before + r.here <= b.rest
      OR (r.before <= b.rest AND 2 * (b.rest - r.before) >= r.here) THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
    JOIN runs r ON s.source IS NOT DISTINCT FROM r.source AND s.place = r.place"""


def contaminated(window: int = decontaminate.WINDOW, coverage: int = decontaminate.COVERAGE) -> str:
    """Windows of templates and of words as texts in place of hashes."""
    units = ", ".join(f"'{u}'" for u in decontaminate.UNITS)

    def tokens(name: str, table: str, key: str) -> str:
        token = r"[0-9]+(?:[.,][0-9]+)*|\p{L}[\p{L}\p{M}]*|[%$€£°]"
        runs = f"list_transform(range(1, len(h) - {window} + 2), lambda i: array_to_string(h[i:i + {window - 1}], chr(31)))"
        return f"""
    {name}_tokens AS (
      SELECT {key}, i - 1 AS pos, f[i] AS x, CASE
        WHEN regexp_matches(f[i], '^[0-9]') THEN '#'
        WHEN regexp_matches(f[i], '^[%$€£°]') OR (lower(f[i]) IN ({units}) AND i > 1 AND regexp_matches(f[i - 1], '^[0-9]')) THEN 'u'
        WHEN regexp_matches(f[i], '^\\p{{Lu}}\\p{{Ll}}') THEN '@' END AS kind
      FROM (SELECT {key}, f, unnest(range(1, len(f) + 1)) AS i
            FROM (SELECT {key}, regexp_extract_all(coalesce(text, ''), '{token}') AS f FROM {table}))),
    {name}_forms AS (
      SELECT {key}, 0 AS form, list(coalesce(kind, lower(x)) ORDER BY pos) AS h FROM {name}_tokens GROUP BY {key}
      UNION ALL SELECT {key}, 1, list(lower(x) ORDER BY pos) FROM {name}_tokens GROUP BY {key}),
    {name}_windows AS (
      SELECT {key}, form, unnest(range(0, len(h) - {window} + 1)) AS pos, unnest({runs}) AS win FROM {name}_forms WHERE len(h) >= {window})"""

    enough = f"100 * matched >= {coverage} * windows"
    return f"""
    WITH {tokens("doc", "documents", "doc_id")}, {tokens("item", "benchmark", "item_id")},
    known AS (SELECT DISTINCT item_id, form, win FROM item_windows),
    sizes AS (SELECT item_id, form, count(*) AS windows FROM known GROUP BY item_id, form),
    held AS (
      SELECT doc_id, item_id, form, windows FROM (
        SELECT doc_id, k.item_id, k.form, count(DISTINCT win) AS matched FROM doc_windows d JOIN known k USING (win) GROUP BY doc_id, k.item_id, k.form)
      JOIN sizes USING (item_id, form) WHERE {enough}),
    aligned AS (
      SELECT h.doc_id, h.item_id, h.form, h.windows, d.pos - i.pos AS shift, i.pos AS spot, d.win FROM held h
      JOIN doc_windows d ON d.doc_id = h.doc_id AND d.form = h.form
      JOIN item_windows i ON i.item_id = h.item_id AND i.form = h.form AND i.win = d.win),
    spans AS (
      SELECT doc_id, item_id, shift, min(spot) AS first, max(spot) + {window - 1} AS last,
        coalesce(list(spot) FILTER (WHERE form = 0), []) AS starts FROM aligned GROUP BY doc_id, item_id, shift),
    slots AS (
      SELECT doc_id, item_id, shift, bool_or(mixed) AS mixed, bool_or(changed) AS changed FROM (
        SELECT s.doc_id, s.item_id, s.shift, i.kind, lower(i.x) AS value, bool_or(lower(d.x) <> lower(i.x)) AS changed,
          count(DISTINCT lower(d.x)) FILTER (WHERE len(list_filter(s.starts, lambda a: i.pos BETWEEN a AND a + {window - 1})) > 0) > 1 AS mixed
        FROM spans s JOIN item_tokens i ON i.item_id = s.item_id AND i.pos BETWEEN s.first AND s.last
        JOIN doc_tokens d ON d.doc_id = s.doc_id AND d.pos = i.pos + s.shift AND d.kind = i.kind
        GROUP BY s.doc_id, s.item_id, s.shift, i.kind, lower(i.x)) GROUP BY doc_id, item_id, shift),
    agreed AS (
      SELECT doc_id, item_id, form, windows, count(DISTINCT win) AS matched, NOT bool_or(coalesce(changed, false)) AS exact
      FROM aligned LEFT JOIN slots USING (doc_id, item_id, shift)
      WHERE form = 1 OR NOT coalesce(mixed, false) GROUP BY doc_id, item_id, form, windows)
    SELECT doc_id, item_id, windows, matched, exact FROM (
      SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, windows DESC, exact DESC) AS rank
      FROM agreed WHERE {enough}) WHERE rank = 1"""


def hard_negatives() -> str:
    """Every anchor against every row."""
    return """
    WITH taking AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
      FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scores AS (
      SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM taking a JOIN taking b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
    positives AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM scores WHERE same)
      WHERE place <= 5),
    ranked AS (
      SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INT) AS rank
      FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
        AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5"""


def manifest() -> str:
    """Each level by grouping the one below, and each leaf's climb."""
    field = lambda c: f"coalesce(concat(octet_length(encode({c})), ':', {c}), '-')"
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)"]
    leaf = lambda text: f"sha256(concat({', '.join(map(field, [*fields, text]))}))"

    def tree(name: str, lowest: str) -> str:
        """Levels, runs and climbs over rows ``tree``, ``place``, ``n``, ``hash`` of ``lowest``."""
        return f"""
    {name}_nodes AS (
      SELECT tree, 0 AS level, place, n, hash FROM {lowest}
      UNION ALL
      SELECT tree, level + 1, place // 16, CAST(ceil(n / 16.0) AS BIGINT), sha256(string_agg(hash, '' ORDER BY place))
      FROM {name}_nodes WHERE n > 1 GROUP BY tree, level, place // 16, n),
    {name}_runs AS (SELECT tree, level, place // 16 AS run, list(hash ORDER BY place) AS kin FROM {name}_nodes WHERE n > 1 GROUP BY ALL)"""

    def climb(name: str, start: str) -> str:
        others = "array_to_string(list_concat(kin[:place % 16], kin[place % 16 + 2:]), '')"
        changed = "sha256(array_to_string(list_concat(kin[:place % 16], [folded], kin[place % 16 + 2:]), ''))"
        return f"""
    {name}_climb AS (
      SELECT id, tree, 0 AS level, place, folded, proof FROM {start}
      UNION ALL
      SELECT id, c.tree, c.level + 1, place // 16, {changed}, concat(proof, {others})
      FROM {name}_climb c JOIN {name}_runs r ON r.tree = c.tree AND r.level = c.level AND r.run = place // 16),
    {name}_end AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY level DESC) AS last FROM {name}_climb) WHERE last = 1)"""

    return f"""
    WITH RECURSIVE crc AS (
      SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
        lambda c, _: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))) AS steps),
    hashed AS (
      SELECT doc_id, coalesce('=' || source, '') AS tree, {leaf("text")} AS hash,
        CASE WHEN xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
          lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) % 5 = 0
        THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS forged
      FROM documents, crc),
    leaves AS (
      SELECT doc_id, tree, hash, coalesce(forged, hash) AS folded, row_number() OVER () AS id, count(*) OVER (PARTITION BY tree) AS n,
        row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, hash) - 1 AS place, '' AS proof FROM hashed),
    {tree("low", "leaves")},
    {climb("low", "leaves")},
    roots AS (
      SELECT '' AS tree, tree AS own, hash, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM low_nodes WHERE n = 1),
    {tree("top", "roots")},
    top_start AS (SELECT id, '' AS tree, r.place, folded, proof FROM low_end e JOIN roots r ON r.own = e.tree),
    {climb("top", "top_start")}
    SELECT l.doc_id, l.hash AS leaf, r.hash AS subroot, t.hash AS root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root,
      e.folded = t.hash AS verified
    FROM leaves l JOIN top_end e USING (id) JOIN roots r ON r.own = l.tree JOIN top_nodes t ON t.n = 1"""


ORACLES = {
    "op2_template_decontamination": contaminated(),
    "op5_hash_threshold_mix": mix(),
    "op9_tensored_minhash": near_duplicates(4),
    "op12_inverted_multi_index": hard_negatives(),
    "op13_merkle_manifest": manifest(),
}
