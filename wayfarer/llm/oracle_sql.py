"""DuckDB statements that state the results of the near-duplicate, repeat and
contamination queries plainly: by whole sets, whole windows and all pairs, with
none of the signatures, phrases, grids or fingerprints of the operators.
"""

from __future__ import annotations

import string

# Words: the longest runs without ASCII white space, or of ASCII letters, digits and all that is not ASCII.
BLANK_CUT = r"[^\x20\x09-\x0D]+"
SIGN_CUT = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Smallest id that each document or vector reaches over the rows of links(a, b), which hold both directions.
_REACH = """
reach(id, root) AS (
  SELECT id, id FROM nodes
  UNION
  SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.id),
component AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)"""


def _lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def near_duplicates(k: int, percent: int) -> str:
    """op1: all pairs that share a shingle, compared by their whole sets."""
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_lower('text')}, '{BLANK_CUT}') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + {k - 1}], ' ') AS shingle
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {k - 1}, 1) + 1)) AS i
            FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
           FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
          WHERE 100 * common >= {percent} * (na.size + nb.size - common)),
nodes AS (SELECT doc_id AS id FROM documents),{_REACH}
SELECT d.doc_id, coalesce(n.size, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN component c ON c.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""


def repeats(span: int) -> str:
    """op3: every window of the corpus counted; words of repeated ones go."""
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{BLANK_CUT}') AS words FROM documents),
windows AS (SELECT doc_id, i, sha256(array_to_string(words[i:i + {span - 1}], ' ')) AS held
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - {span - 2})) AS i
                  FROM w WHERE len(words) >= {span})),
repeated AS (SELECT held FROM windows GROUP BY held HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {span})) AS pos
         FROM windows SEMI JOIN repeated USING (held)),
word AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w),
kept AS (SELECT word.doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n
         FROM word ANTI JOIN gone ON gone.doc_id = word.doc_id AND gone.pos = word.pos GROUP BY word.doc_id)
SELECT w.doc_id, len(words) AS n_words, len(words) - coalesce(kept.n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id"""


def close_vectors(least: float) -> str:
    """op7: the cosines of all pairs in double precision."""
    return f"""
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND list_count(embedding) = len(embedding) AND isfinite(list_sum(CAST(embedding AS DOUBLE[])))),
u AS MATERIALIZED (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS norm FROM v
                   WHERE list_inner_product(e, e) > 0),
links AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b FROM u x JOIN u y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_inner_product(x.e, y.e) / (x.norm * y.norm) >= {least}),
nodes AS (SELECT vec_id AS id FROM embeddings),{_REACH},
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT m.vec_id, coalesce(degree.n, 0) AS n_links, c.component_id, m.vec_id = c.component_id AS kept
FROM embeddings m JOIN component c ON c.id = m.vec_id LEFT JOIN degree ON degree.a = m.vec_id"""


def contamination(span: int) -> str:
    """op10: every window of the benchmark looked up at every document position."""
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_lower('text')}, '{SIGN_CUT}') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all({_lower('text')}, '{SIGN_CUT}') AS words FROM benchmark),
item AS (SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS held
         FROM (SELECT item_id, words, least(len(words), {span}) AS size,
                      unnest(range(1, greatest(len(words) - {span}, 0) + 2)) AS i FROM b WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM item),
place AS (SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS held
          FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
                FROM d JOIN sizes ON len(words) >= size)),
hit AS (SELECT doc_id, item_id, i, size FROM place JOIN item USING (size, held)),
hit_word AS (SELECT doc_id, count(DISTINCT pos) AS n
             FROM (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(words) AS n_words, coalesce(hit_word.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(hit_word.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_word ON hit_word.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id"""
