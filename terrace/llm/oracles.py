"""DuckDB SQL for the training-data queries that SQL can express on whole tables.

Not here, and tested against brute force instead: token counts and packing (merges of a
tokenizer), the checksums of sharding, cube sampling, the classifier, and the pipeline that
is made of them.
"""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_VECTORS = """SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0"""

_REACH = """reach AS (SELECT id, id AS root FROM nodes
    UNION SELECT l.v, r.root FROM reach r JOIN links l ON l.u = r.id),
  component AS (SELECT id, min(root) AS root FROM reach GROUP BY id)"""

_WORD = r"[^\x20\x09-\x0D]+"


def _lowered(x: str) -> str:
    return f"translate({x}, '{UPPER}', '{LOWER}')"


def _pages(rounds: int = 150, threshold: float = 0.5) -> str:
    # The longest rule that fits comes first: example.net/en/, example.com/de/, org/fr/, net/.
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", f"'{h}{p}'", f"'{v}'")
            for v, h, p in (("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"), ("block", "net", "/"))]
    rule = "CASE " + " ".join(f"WHEN {t} THEN {r}" for t, r, _ in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {t} THEN {v}" for t, _, v in fits) + " END"
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    link = r"""(?i)(?:href|src)\s*=\s*["'']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"''\s<>]+)"""
    steps = []
    for k in range(rounds):
        steps.append(f"""r{k + 1} AS MATERIALIZED (SELECT s.host, s.good, s.bad,
          (0.15 + 0.85 * coalesce((SELECT sum(trust) FROM r{k} WHERE host NOT IN (SELECT src FROM edges)), 0)) * s.good
            + 0.85 * coalesce((SELECT sum(r.trust / o.n) FROM edges e JOIN r{k} r ON r.host = e.src
                JOIN n_out o ON o.host = e.src WHERE e.dst = s.host), 0) AS trust,
          (0.15 + 0.85 * coalesce((SELECT sum(distrust) FROM r{k} WHERE host NOT IN (SELECT dst FROM edges)), 0)) * s.bad
            + 0.85 * coalesce((SELECT sum(r.distrust / i.n) FROM edges e JOIN r{k} r ON r.host = e.dst
                JOIN n_in i ON i.host = e.dst WHERE e.src = s.host), 0) AS distrust
          FROM seeds s)""")
    return f"""WITH parts AS (SELECT page_id, html, {_lowered(f"regexp_extract(coalesce(url, ''), '{parts}', 1)")} AS host,
        regexp_extract(coalesce(url, ''), '{parts}', 2) AS path FROM pages),
      p AS MATERIALIZED (SELECT *, {rule} AS rule, {verdict} AS by_rule FROM parts),
      edges AS MATERIALIZED (SELECT DISTINCT host AS src, dst FROM (SELECT host,
          unnest(list_transform(regexp_extract_all(coalesce(html, ''), '{link}', 1), lambda h: {_lowered('h')})) AS dst FROM p)
        WHERE host <> dst AND host <> ''),
      n_out AS (SELECT src AS host, count(*) AS n FROM edges GROUP BY 1),
      n_in AS (SELECT dst AS host, count(*) AS n FROM edges GROUP BY 1),
      hosts AS MATERIALIZED (SELECT host, coalesce(2 * sum(by_rule = 'allow') > sum(seen), false) AS g,
          coalesce(2 * sum(by_rule = 'block') > sum(seen), false) AS b
        FROM (SELECT host, by_rule, 1 AS seen FROM p WHERE host <> ''
              UNION ALL SELECT src, NULL, 0 FROM edges UNION ALL SELECT dst, NULL, 0 FROM edges) GROUP BY host),
      seeds AS MATERIALIZED (SELECT host, CASE WHEN g THEN 1.0 / (SELECT sum(CAST(g AS INT)) FROM hosts) ELSE 0.0 END::DOUBLE AS good,
          CASE WHEN b THEN 1.0 / (SELECT sum(CAST(b AS INT)) FROM hosts) ELSE 0.0 END::DOUBLE AS bad FROM hosts),
      r0 AS MATERIALIZED (SELECT *, good AS trust, bad AS distrust FROM seeds),
      {", ".join(steps)}
      SELECT p.page_id, p.host, p.path, p.rule, coalesce(p.by_rule,
          CASE WHEN r.distrust > r.trust AND r.distrust * (SELECT count(*) FROM hosts) >= {threshold} THEN 'block' ELSE 'allow' END) AS verdict
      FROM p LEFT JOIN r{rounds} r ON r.host = p.host"""


def _codes(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (SELECT r, p, e, d FROM (
            SELECT x.r, x.p, c.e, sum((x.x - c.x) * (x.x - c.x)) AS d FROM x JOIN c{k} c ON x.p = c.p AND x.j = c.j GROUP BY ALL)
          QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1)""")
        if k < rounds:
            steps.append(f"""c{k + 1} AS MATERIALIZED (SELECT c.p, c.e, c.j, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN
              (SELECT p, e, j, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (SELECT a.p, a.e, x.j, sum(x.x) AS s, count(*) AS n
                FROM a{k} a JOIN x ON x.r = a.r AND x.p = a.p GROUP BY ALL)) m ON m.p = c.p AND m.e = c.e AND m.j = c.j)""")
    return f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
          list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
      x AS MATERIALIZED (SELECT r, (i - 1) // (n // {parts}) AS p, (i - 1) % (n // {parts}) AS j, x FROM (
        SELECT r, len(v) AS n, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM kept)),
      c0 AS MATERIALIZED (SELECT p, r - 1 AS e, j, x FROM x WHERE r <= {entries}),
      {", ".join(steps)},
      coded AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r)
      SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
        (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, j)) FROM c{rounds}) AS codebooks_sha256
      FROM kept k JOIN coded c ON c.r = k.r"""


_ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


ORACLES: dict[str, str] = {
    "op1_pivot_near_vectors": f"""WITH RECURSIVE nodes AS (SELECT vec_id AS id, label, v FROM ({_VECTORS}) WHERE label IS NOT NULL),
      links AS (SELECT a.id AS u, b.id AS v FROM nodes a JOIN nodes b ON a.label = b.label AND a.id <> b.id
          AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98),
      {_REACH}
      SELECT e.vec_id, coalesce(l.n, 0)::BIGINT AS n_links, coalesce(c.root, e.vec_id) AS component_id,
        coalesce(c.root, e.vec_id) = e.vec_id AS kept
      FROM embeddings e LEFT JOIN component c ON c.id = e.vec_id
      LEFT JOIN (SELECT u, count(*) AS n FROM links GROUP BY u) l ON l.u = e.vec_id""",
    "op3_parity_sketch_join": f"""WITH RECURSIVE words AS (SELECT doc_id,
        regexp_extract_all({_lowered("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
      sets AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1),
          lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
      grams AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
      nodes AS (SELECT doc_id AS id FROM sets),
      links AS MATERIALIZED (SELECT a.doc_id AS u, b.doc_id AS v FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
      {_REACH}
      SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.root AS component_id FROM sets s JOIN component c ON c.id = s.doc_id""",
    "op5_line_dedup": f"""WITH lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS no
        FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
      own AS MATERIALIZED (SELECT doc_id, line, no, len(regexp_extract_all(line, '{_WORD}')) AS words FROM lines
        WHERE regexp_matches(line, '{_WORD}')),
      summed AS MATERIALIZED (SELECT *, row_number() OVER d AS i, sum(words) OVER d AS upto FROM own
        WINDOW d AS (PARTITION BY doc_id ORDER BY no)),
      -- A run of 50 words or more is the union of the shortest such runs from each of its lines on and,
      -- for lines too near its end, the shortest that ends where it ends.
      runs AS MATERIALIZED (SELECT a.doc_id, a.i, min(b.i) AS e FROM summed a JOIN summed b
          ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.words >= 50 GROUP BY ALL
        UNION SELECT b.doc_id, max(a.i) AS i, b.i AS e FROM summed a JOIN summed b
          ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.words >= 50 GROUP BY b.doc_id, b.i),
      stretches AS (SELECT x.doc_id, x.i, min(s.no) AS no, max(s.no) AS last, string_agg(s.line, chr(10) ORDER BY s.i) AS body
        FROM runs x JOIN summed s ON s.doc_id = x.doc_id AND s.i BETWEEN x.i AND x.e GROUP BY x.doc_id, x.i, x.e),
      later AS (SELECT * FROM stretches QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, i) > 1),
      gone AS (SELECT DISTINCT doc_id, unnest(generate_series(no, last)) AS no FROM later),
      kept AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.no) FILTER (WHERE g.no IS NULL) AS text,
          count(*) AS n_lines, count(g.no) AS n_deleted
        FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.no = l.no GROUP BY l.doc_id)
      SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
        coalesce(k.n_lines, 0)::INTEGER AS n_lines, coalesce(k.n_deleted, 0)::INTEGER AS n_deleted
      FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id""",
    "op7_link_trust": _pages(),
    "op8_one_bit_search": f"""WITH nodes AS ({_VECTORS}),
      near AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score FROM nodes q JOIN nodes c
        ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
      SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
      FROM near QUALIFY rank <= 20""",
    "op11_fill_middle": """WITH given AS (SELECT doc_id, coalesce(text, '') AS text,
        sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
      cut AS (SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u,
        list_transform([1, 9, 17, 25], lambda k: CAST('0x' || substr(h, k, 8) AS BIGINT)) AS h FROM given),
      placed AS (SELECT *, len(u) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
          WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM cut),
      pieces AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
        coalesce(array_to_string(u[b + 1:n], ''), '') AS s FROM placed)
      SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
          ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256 FROM pieces""",
    "op12_leak_scan": f"""WITH item AS (SELECT item_id, regexp_extract_all({_lowered("text")}, '{_ITEM_WORD}') AS w FROM benchmark),
      windows AS MATERIALIZED (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(w), 10) AS m, unnest(list_transform(
        range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS g FROM item WHERE len(w) > 0),
      doc AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all({_lowered("text")}, '{_ITEM_WORD}'), []) AS w FROM documents),
      grams AS (SELECT r, s.m, unnest(range(1, len(w) - s.m + 2)) AS i, w FROM doc, (SELECT DISTINCT m FROM windows) s WHERE len(w) >= s.m),
      found AS MATERIALIZED (SELECT r, d.m, i, x.item FROM (SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS g FROM grams) d
        JOIN windows x ON x.m = d.m AND x.g = d.g),
      words AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + m)) AS j FROM found) GROUP BY r),
      items AS (SELECT r, list_sort(list(DISTINCT item)) AS ids FROM found WHERE item IS NOT NULL GROUP BY r)
      SELECT d.doc_id, len(d.w) AS n_words, coalesce(w.n, 0) AS n_hit, coalesce(len(i.ids), 0) AS n_items,
        sha256(coalesce(array_to_string(i.ids, ','), '')) AS items_sha256, w.n IS NOT NULL AS contaminated
      FROM doc d LEFT JOIN words w ON w.r = d.r LEFT JOIN items i ON i.r = d.r""",
    "op13_dual_tree_codes": _codes(),
}
