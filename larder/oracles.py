"""The registered queries in DuckDB SQL, over whole tables."""

from __future__ import annotations

_RATED = """
SELECT p.p_name AS title, avg(l.l_quantity) AS avg_rating, count(*) AS n_ratings
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
GROUP BY l.l_partkey, p.p_name
HAVING count(*) >= 20
ORDER BY avg_rating DESC NULLS LAST, l.l_partkey, title
LIMIT 20
"""

_QUICK = """
SELECT p_partkey AS recipe_id, p_name AS title, p_size AS "minutes"
FROM part WHERE p_size < 30
ORDER BY p_size, p_partkey
LIMIT 20
"""

_SEARCH = """
SELECT o.o_orderkey AS recipe_id, o.o_orderpriority AS title, p.p_name AS matched_ingredient
FROM orders o
JOIN lineitem l ON l.l_orderkey = o.o_orderkey
JOIN part p ON p.p_partkey = l.l_partkey
WHERE p.p_name = 'cold widget'
"""

_BOTH = """
SELECT o.o_orderkey AS recipe_id, o.o_orderpriority AS title,
       concat('cold widget', ', ', 'small widget') AS matched_ingredients
FROM orders o
WHERE o.o_orderkey IN (SELECT l_orderkey FROM lineitem JOIN part ON p_partkey = l_partkey
                       WHERE p_name = 'cold widget')
  AND o.o_orderkey IN (SELECT l_orderkey FROM lineitem JOIN part ON p_partkey = l_partkey
                       WHERE p_name = 'small widget')
"""

_DOCUMENTS = "SELECT doc_id, text, lang, source, n_chars FROM documents"


def _norm(text: str) -> str:
    stripped = f"regexp_replace(lower({text}), '[^a-z0-9\\s]', ' ', 'g')"
    return f"trim(regexp_replace({stripped}, '\\s+', ' ', 'g'))"


# Every word of every text, as the list literal holds it: escapes are not undone.
_WORDS = r"""
words AS (
  SELECT doc_id, lang, replace(replace(word, '\', '\\'), '''', '\''') AS word
  FROM (SELECT doc_id, lang, unnest(string_split_regex(text, '\s+')) AS word FROM documents)
)
"""

_ITEMS = f"""
{_WORDS},
items AS (
  SELECT DISTINCT doc_id, lang, {_norm("word")} AS name FROM words WHERE length({_norm("word")}) > 0
),
dim AS (
  SELECT CAST(row_number() OVER (ORDER BY name) AS INTEGER) AS ingredient_id, name
  FROM (SELECT DISTINCT name FROM items)
)
"""

_DIGITS = "regexp_replace(props, '[^0-9]', '', 'g')"


def _rule(tbl: str, rule: str, count: str, source: str) -> str:
    return (
        f"SELECT '{tbl}' AS tbl, '{rule}' AS rule, CAST({count} AS BIGINT) AS violations "
        f"FROM {source}"
    )


def _not_null(tbl: str, column: str, expr: str, source: str) -> str:
    return _rule(tbl, f"not null {column}", f"count(*) FILTER ({expr} IS NULL)", source)


def _bounded(tbl: str, column: str, n: int, expr: str, source: str) -> str:
    return _rule(
        tbl, f"length {column} <= {n}", f"count(*) FILTER (length({expr}) > {n})", source
    )


def _unique(tbl: str, key: str, exprs: str, source: str) -> str:
    repeated = f"(SELECT {exprs} FROM {source} GROUP BY {exprs} HAVING count(*) > 1)"
    return _rule(tbl, f"unique ({key})", "count(*)", repeated)


def _reference(tbl: str, rule: str, expr: str, source: str, parent: str, key: str) -> str:
    lost = f"{source} WHERE {expr} IS NOT NULL AND {expr} NOT IN (SELECT {key} FROM {parent})"
    return _rule(tbl, rule, "count(*)", lost)


_SCHEMA_AUDIT = "\nUNION ALL\n".join(
    [
        _not_null("recipes", "recipe_id", "o_orderkey", "orders"),
        _not_null("recipes", "title", "o_orderpriority", "orders"),
        _not_null("recipes", "source", "'orders'", "orders"),
        _bounded("recipes", "title", 512, "o_orderpriority", "orders"),
        _bounded("recipes", "source", 32, "'orders'", "orders"),
        _unique("recipes", "recipe_id", "o_orderkey", "orders"),
        _not_null("ingredients", "ingredient_id", "p_partkey", "part"),
        _not_null("ingredients", "ingredient_name_raw", "p_name", "part"),
        _not_null("ingredients", "ingredient_name_norm", "p_name", "part"),
        _bounded("ingredients", "ingredient_name_raw", 255, "p_name", "part"),
        _bounded("ingredients", "ingredient_name_norm", 255, "p_name", "part"),
        _unique("ingredients", "ingredient_id", "p_partkey", "part"),
        _unique("ingredients", "ingredient_name_norm", "p_name", "part"),
        _not_null("recipe_ingredients", "recipe_id", "l_orderkey", "lineitem"),
        _not_null("recipe_ingredients", "ingredient_id", "l_partkey", "lineitem"),
        _unique(
            "recipe_ingredients",
            "recipe_id, ingredient_id",
            "l_orderkey, l_partkey",
            "lineitem",
        ),
        _reference(
            "recipe_ingredients",
            "recipe_id -> recipes.recipe_id",
            "l_orderkey",
            "lineitem",
            "orders",
            "o_orderkey",
        ),
        _reference(
            "recipe_ingredients",
            "ingredient_id -> ingredients.ingredient_id",
            "l_partkey",
            "lineitem",
            "part",
            "p_partkey",
        ),
        _not_null("interactions", "interaction_id", "doc_id", "labels"),
        _not_null("interactions", "user_id", "quality", "labels"),
        _not_null("interactions", "recipe_id", "doc_id", "labels"),
        _unique("interactions", "interaction_id", "doc_id", "labels"),
        _reference(
            "interactions",
            "recipe_id -> recipes.recipe_id",
            "doc_id",
            "labels",
            "orders",
            "o_orderkey",
        ),
    ]
)

# Ids of non-English documents are moved by the second source's offset.
_CURATED = f"""
WITH {_ITEMS},
recipes AS (
  SELECT CASE WHEN lang = 'en' THEN doc_id ELSE doc_id + 10000000 END AS recipe_id
  FROM documents
)
"""

_TABLES = " UNION ALL ".join(
    f"SELECT '{name}' AS name, count(*) AS n FROM {name}"
    for name in ("documents", "events", "labels", "lineitem", "orders", "part", "supplier")
)

# Values of the English raw recipes that their types refuse, with the document they are from.
_REFUSED = """
SELECT concat_ws(' ', source, doc_id) AS name, column_name, raw_text, reason, false AS dropped
FROM (
  SELECT source, doc_id, 'minutes' AS column_name, '99999999999' AS raw_text, 'out of range' AS reason
  FROM documents WHERE lang = 'en' AND doc_id % 7 = 0
  UNION ALL
  SELECT source, doc_id, 'n_steps', 'x7', 'malformed' FROM documents WHERE lang = 'en' AND doc_id % 3 = 1
  UNION ALL
  SELECT source, doc_id, 'n_ingredients', 'many', 'malformed' FROM documents
  WHERE lang = 'en' AND doc_id % 5 = 0
  UNION ALL
  SELECT source, doc_id, 'submitted', CASE WHEN doc_id % 4 = 0 THEN '2020-02-30' ELSE 'soon' END,
         'malformed'
  FROM documents WHERE lang = 'en' AND doc_id % 4 < 2
)
"""

_KEY = "CASE WHEN lang = 'en' THEN doc_id ELSE doc_id + 10000000 END"

ORACLES = {
    "top_rated": _RATED,
    "top_rated_agg_first": _RATED,
    "layout_top_rated": _RATED,
    "quick_recipes": _QUICK,
    "layout_quick": _QUICK,
    "layout_plain": _QUICK,
    "ingredient_search": _SEARCH + "ORDER BY recipe_id LIMIT 20",
    "ingredient_search_all": _SEARCH,
    "layout_search": _SEARCH,
    "multi_ingredient": _BOTH + "ORDER BY recipe_id LIMIT 20",
    "multi_ingredient_k": _BOTH,
    "csv_roundtrip": _DOCUMENTS,
    "csv_split_landing": _DOCUMENTS,
    "csv_odd_landing": _DOCUMENTS,
    "curated_load_mixed_headers": """
SELECT o_orderkey AS recipe_id, o_orderpriority AS title, CAST(o_custkey AS INTEGER) AS "minutes",
       CAST(NULL AS INTEGER) AS n_steps, CAST(length(o_orderpriority) AS INTEGER) AS n_ingredients,
       CAST(o_orderdate AS DATE) AS submitted, o_orderstatus AS source
FROM orders
""",
    "curated_load": """
SELECT o_orderkey AS recipe_id, o_orderpriority AS title,
       CAST(CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS INTEGER) AS "minutes",
       CAST(nullif(length(o_orderpriority), 8) AS INTEGER) AS n_steps,
       try_cast(replace(o_orderpriority, '-LOW', '') AS INTEGER) AS n_ingredients,
       CAST(o_orderdate AS DATE) AS submitted, 'orders' AS source
FROM orders
""",
    "blank_to_null": """
SELECT doc_id, nullif(replace(lang, 'en', ''), '') AS foreign_lang, nullif(source, '') AS source
FROM documents
""",
    "cast_lenient": f"""
SELECT event_id, try_cast(replace(props, '{{"k": 9}}', '9') AS BIGINT) AS nine,
       try_cast({_DIGITS} AS INTEGER) AS k,
       try_cast({_DIGITS} || {_DIGITS} AS TINYINT) AS k_twice,
       CAST(ts AS DATE) AS "day",
       try_cast(strftime(ts, '%Y-%m-') || lpad({_DIGITS}, 2, '0') AS DATE) AS some_day
FROM events
""",
    "conform_union": """
SELECT o_orderkey AS recipe_id, o_orderpriority AS title, CAST(o_custkey AS INTEGER) AS "minutes",
       try_cast(replace(o_orderpriority, '-LOW', '') AS INTEGER) AS n_steps,
       CAST(length(o_orderpriority) AS INTEGER) AS n_ingredients,
       CAST(o_orderdate AS DATE) AS submitted, 'foodcom' AS source
FROM orders
UNION ALL
SELECT s_suppkey + 10000000, s_name, CAST(NULL AS INTEGER), CAST(NULL AS INTEGER),
       CAST(NULL AS INTEGER), CAST(NULL AS DATE), 'recipenlg'
FROM supplier
""",
    "normalize_text": f"""
SELECT doc_id, {_norm("text")} AS norm, CAST(length({_norm("text")}) AS INTEGER) AS norm_length
FROM documents
""",
    "parse_explode": f"""
WITH {_WORDS}
SELECT doc_id, count(*) AS n_items, CAST(sum(length(word)) AS BIGINT) AS n_item_chars,
       min(word) AS first_item, max(word) AS last_item
FROM words GROUP BY doc_id
""",
    "ingredient_dim": f"""
WITH {_ITEMS}
SELECT ingredient_id, name AS ingredient_name_raw, name AS ingredient_name_norm FROM dim
""",
    "recipe_ingredients": f"""
WITH {_ITEMS}
SELECT doc_id AS recipe_id, ingredient_id FROM items JOIN dim USING (name)
""",
    "dedup_by_key": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, shipped
FROM (
  SELECT *, CAST(l_shipdate AS DATE) AS shipped,
         row_number() OVER (
           PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
                    l_quantity NULLS FIRST, l_extendedprice NULLS FIRST,
                    CAST(l_shipdate AS DATE) NULLS FIRST) AS rn
  FROM lineitem)
WHERE rn = 1
""",
    "row_ids": """
SELECT l_suppkey AS user_id, l_partkey AS recipe_id, CAST(l_quantity AS TINYINT) AS rating,
       CAST(l_shipdate AS DATE) AS interaction_date,
       CAST(1 AS BIGINT) AS first_id, count(*) OVER () AS last_id, count(*) OVER () AS n_ids
FROM lineitem
""",
    "interactions_fk": """
SELECT doc_id, quality, toxic FROM labels
WHERE doc_id IN (SELECT doc_id FROM documents WHERE lang = 'en')
""",
    "fk_orphans": """
SELECT doc_id, count(*) AS n_rows FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id
""",
    "row_counts": """
SELECT 'recipes' AS tbl, count(*) AS n FROM orders UNION ALL
SELECT 'ingredients', count(*) FROM part UNION ALL
SELECT 'recipe_ingredients', count(*) FROM lineitem UNION ALL
SELECT 'interactions', count(*) FROM labels
""",
    "schema_audit": _SCHEMA_AUDIT,
    "key_audit": """
SELECT CAST(sum(n) AS BIGINT) AS n_rows,
       count(*) FILTER (NOT has_null) AS n_keys,
       count(*) FILTER (NOT has_null AND n > 1) AS n_repeated,
       CAST(coalesce(sum(n) FILTER (has_null), 0) AS BIGINT) AS n_null_keys
FROM (
  SELECT count(*) AS n, l_orderkey IS NULL OR l_linenumber IS NULL AS has_null
  FROM lineitem GROUP BY l_orderkey, l_linenumber)
""",
    "duplicate_keys": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""",
    "length_audit": """
SELECT count(*) FILTER (length(text) > 512) AS text_too_long,
       count(*) FILTER (length(source) > 32) AS source_too_long,
       count(*) FILTER (length(lang) > 1) AS lang_too_long
FROM documents
""",
    "null_audit": """
SELECT count(*) FILTER (doc_id IS NULL) AS doc_id_nulls,
       count(*) FILTER (text IS NULL) AS text_nulls,
       count(*) FILTER (lang IS NULL) AS lang_nulls,
       count(*) FILTER (source IS NULL) AS source_nulls,
       count(*) FILTER (n_chars IS NULL) AS n_chars_nulls
FROM documents
""",
    "file_inventory": f"""
SELECT name || '.parquet' AS file, n AS n_rows FROM ({_TABLES})
""",
    "directory_totals": f"""
SELECT count(*) AS n_files, CAST(sum(n) AS BIGINT) AS n_rows FROM ({_TABLES}) WHERE n > 0
""",
    "missing_files": f"""
SELECT file FROM (VALUES ('orders.parquet'), ('recipes.parquet'), ('interactions.parquet')) v(file)
WHERE file NOT IN (SELECT name || '.parquet' FROM ({_TABLES}) WHERE n > 0)
""",
    "layout_zorder": f"""
SELECT *, 'minutes' AS asked FROM ({_QUICK})
UNION ALL
SELECT p_partkey, p_name, p_size, 'recipe_id' FROM part WHERE p_partkey <= 20
""",
    "layout_bloom_lookup": """
SELECT l_orderkey AS recipe_id, l_partkey AS ingredient_id, count(*) AS n_rows
FROM lineitem WHERE l_orderkey = 1 GROUP BY l_orderkey, l_partkey
""",
    "stable_ids": f"""
WITH {_ITEMS},
first_load AS (SELECT DISTINCT name FROM items WHERE lang = 'en'),
numbered AS (
  SELECT name, row_number() OVER (ORDER BY name) AS id FROM first_load
  UNION ALL
  SELECT name, (SELECT count(*) FROM first_load) + row_number() OVER (ORDER BY name)
  FROM (SELECT DISTINCT name FROM items WHERE name NOT IN (SELECT name FROM first_load))
)
SELECT CAST(id AS INTEGER) AS ingredient_id, name AS ingredient_name_raw,
       name AS ingredient_name_norm
FROM numbered
""",
    "incremental_landing": _DOCUMENTS,
    "top_rated_maintained": _RATED,
    "multi_ingredient_bitmap": _BOTH,
    "rejected_values": _REFUSED,
    "rejected_summary": f"""
SELECT count(*) AS n_rows, count(*) AS n_kept, CAST(0 AS BIGINT) AS n_dropped,
       (SELECT count(*) FROM ({_REFUSED})) AS n_values_lost
FROM documents WHERE lang = 'en'
""",
    "refreshed_tables": f"""
{_CURATED}
SELECT 'recipes' AS tbl, count(*) AS n FROM recipes UNION ALL
SELECT 'ingredients', count(*) FROM dim UNION ALL
SELECT 'recipe_ingredients', count(*) FROM items UNION ALL
SELECT 'interactions', count(*) FROM labels WHERE doc_id IN (SELECT recipe_id FROM recipes)
""",
    "curated_tables": f"""
{_CURATED}
SELECT 'recipes' AS tbl, count(*) AS n FROM recipes UNION ALL
SELECT 'ingredients', count(*) FROM dim UNION ALL
SELECT 'recipe_ingredients', count(*) FROM items UNION ALL
SELECT 'interactions', count(*) FROM labels WHERE doc_id IN (SELECT recipe_id FROM recipes)
""",
    "curated_recipes": f"""
SELECT {_KEY} AS recipe_id, concat_ws(' ', source, doc_id) AS title,
       CASE WHEN lang = 'en' AND doc_id % 7 <> 0 THEN CAST(n_chars AS INTEGER) END AS "minutes",
       CASE WHEN lang = 'en' AND doc_id % 3 = 0 THEN CAST(doc_id % 50 AS INTEGER) END AS n_steps,
       CASE WHEN lang = 'en' AND doc_id % 5 <> 0 THEN CAST(doc_id % 40 AS INTEGER) END
         AS n_ingredients,
       CASE WHEN lang = 'en' AND doc_id % 4 = 2
            THEN DATE '2019-05-01' + CAST(doc_id % 28 AS INTEGER) END AS submitted,
       CASE WHEN lang = 'en' THEN 'foodcom' ELSE 'recipenlg' END AS source
FROM documents
""",
    "curated_junction": f"""
WITH {_ITEMS}
SELECT {_KEY} AS recipe_id, ingredient_id,
       name AS ingredient_name_raw, name AS ingredient_name_norm
FROM items JOIN dim USING (name)
""",
    "curated_interactions": f"""
SELECT CAST(toxic AS BIGINT) AS user_id, doc_id AS recipe_id,
       CASE WHEN doc_id % 4 <> 0 THEN CAST(quality AS TINYINT) END AS rating,
       CASE WHEN doc_id % 3 = 0 THEN DATE '2020-01-01' + CAST(doc_id % 28 AS INTEGER) END
         AS interaction_date,
       CAST(1 AS BIGINT) AS first_id, count(*) OVER () AS last_id, count(*) OVER () AS n_ids
FROM labels
WHERE toxic IS NOT NULL
  AND doc_id IN (SELECT {_KEY} FROM documents)
""",
    "curated_search": f"""
WITH {_ITEMS}
SELECT CASE WHEN lang = 'en' THEN doc_id ELSE doc_id + 10000000 END AS recipe_id,
       concat_ws(' ', source, doc_id) AS title, 'the, of' AS matched_ingredients
FROM documents
WHERE doc_id IN (SELECT doc_id FROM items WHERE name = 'the')
  AND doc_id IN (SELECT doc_id FROM items WHERE name = 'of')
""",
}
