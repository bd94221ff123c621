"""The integrity suite over documents and their labels (A25)."""

from __future__ import annotations

from pyspark.sql import functions as F

from countertide.catalog.registry import query
from countertide.operators import integrity_suite

# A tag with missing values of several kinds, other spellings, numbers and rubbish.
_ROWS_SQL = """SELECT doc_id, source, lang, n_chars, quality, CASE WHEN doc_id % 97 = 0 THEN 'N/A' WHEN doc_id % 89 = 0 THEN NULL
       WHEN doc_id % 83 = 0 THEN '--!' WHEN doc_id % 11 = 0 THEN CAST(doc_id AS VARCHAR) WHEN doc_id % 7 = 0 THEN upper(lang) || '.'
       WHEN doc_id % 61 = 0 THEN source || source || source ELSE lang END AS tag
FROM documents JOIN labels USING (doc_id)"""
_STRINGS = ("source", "lang", "tag")
_LONG_SQL = " UNION ALL ".join(f"SELECT '{c}' AS col, {c} AS v FROM rows" for c in _STRINGS)
_WORDS = "['', 'null', 'none', 'nan', 'na', 'n/a', '-']"
_NUMERIC = ("doc_id", "n_chars")
_FEATURES = ("doc_id", "source", "lang", "n_chars", "tag")


def _cell(c: str) -> str:
    if c in _NUMERIC:
        return f"coalesce(CAST(len(list_filter(b.{c}, lambda x: rows.{c} > x)) AS VARCHAR), 'null')"
    return f"coalesce({c}, 'null')"


_POWER_SQL = " UNION ALL ".join(f"SELECT '{c}' AS feature, {_cell(c)} AS bin, fold, y FROM folded rows, b" for c in _FEATURES)
_SHARES = "[" + ", ".join(str(k / 16) for k in range(1, 16)) + "]"

SQL = f"""WITH rows AS MATERIALIZED ({_ROWS_SQL}),
long AS MATERIALIZED ({_LONG_SQL}),
real AS (SELECT col, v, v IS NULL OR list_contains({_WORDS}, lower(trim(v))) AS gone FROM long),
counts AS (SELECT col, count(*) FILTER (NOT gone) AS n, count(*) FILTER (NOT gone AND regexp_matches(v, '^[+-]?[0-9]+(\\.[0-9]+)?$')) AS numbers,
  count(*) FILTER (NOT gone AND NOT regexp_matches(v, '[\\p{{L}}\\p{{N}}]')) AS special,
  count(DISTINCT CASE WHEN v IS NULL THEN 'really null' WHEN gone THEN lower(trim(v)) END) AS kinds FROM real GROUP BY col),
forms AS (SELECT col, regexp_replace(lower(v), '[^\\p{{L}}\\p{{N}}]', '', 'g') AS base, count(DISTINCT v) AS n FROM long WHERE v IS NOT NULL GROUP BY ALL),
quartile AS (SELECT col, quantile_disc(length(v), 0.25) AS q1, quantile_disc(length(v), 0.75) AS q3 FROM long WHERE v IS NOT NULL GROUP BY col),
folded AS MATERIALIZED (SELECT *, CAST(quality AS DOUBLE) AS y, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 3 AS fold
  FROM rows WHERE quality IS NOT NULL),
b AS (SELECT list_distinct(quantile_disc(doc_id, {_SHARES})) AS doc_id, list_distinct(quantile_disc(n_chars, {_SHARES})) AS n_chars FROM folded),
cells AS MATERIALIZED ({_POWER_SQL}),
own AS (SELECT x.feature, x.bin, x.fold, count(*) AS n, sum(x.y) AS s, sum(x.y * x.y) AS q FROM cells x GROUP BY ALL),
other AS (SELECT a.feature, a.bin, a.fold, a.n, a.s, a.q,
    sum(o.s) FILTER (o.bin = a.bin) / sum(o.n) FILTER (o.bin = a.bin) AS near, sum(o.s) / sum(o.n) AS far
  FROM own a JOIN own o ON o.feature = a.feature AND o.fold <> a.fold GROUP BY ALL),
power AS (SELECT feature, greatest(1 - sum(q - 2 * coalesce(near, far) * s + coalesce(near, far) ** 2 * n)
    / sum(q - 2 * far * s + far ** 2 * n), 0) AS value FROM other GROUP BY feature),
found AS (
  SELECT 'mixed_nulls' AS "check", col AS "column", CAST(kinds AS DOUBLE) AS value, kinds > 1 AS bad FROM counts
  UNION ALL SELECT 'mixed_types', col, least(numbers, n - numbers) / CAST(n AS DOUBLE),
    least(numbers, n - numbers) / CAST(n AS DOUBLE) BETWEEN 0.01000001 AND 0.19999999 FROM counts
  UNION ALL SELECT 'special_characters', col, special / CAST(n AS DOUBLE), special / CAST(n AS DOUBLE) > 0.001 FROM counts
  UNION ALL SELECT 'string_mismatch', col, CAST(count(*) FILTER (n > 1) AS DOUBLE), count(*) FILTER (n > 1) > 0 FROM forms WHERE base <> '' GROUP BY col
  UNION ALL SELECT 'length_outliers', col, avg(CAST(length(v) < q1 - 3 * (q3 - q1) OR length(v) > q3 + 3 * (q3 - q1) AS INTEGER)),
    avg(CAST(length(v) < q1 - 3 * (q3 - q1) OR length(v) > q3 + 3 * (q3 - q1) AS INTEGER)) > 0.01
    FROM long JOIN quartile USING (col) WHERE v IS NOT NULL GROUP BY col
  UNION ALL SELECT CASE WHEN feature = 'doc_id' THEN 'identifier_label' ELSE 'predictive_power' END, feature, value,
    value > CASE WHEN feature = 'doc_id' THEN 0.2 ELSE 0.8 END FROM power)
SELECT "check", "column", value, CASE WHEN (SELECT count(*) FROM rows) < 50 THEN 'skipped' WHEN bad THEN 'failed' ELSE 'passed' END AS status FROM found"""


@query("integrity_suite", SQL, doubles="value")
def _(t):
    rows = t.given("documents").join(t.given("labels"), "doc_id")
    k = F.col("doc_id")
    tag = (
        F.when(k % 97 == 0, "N/A")
        .when(k % 89 == 0, F.lit(None).cast("string"))
        .when(k % 83 == 0, "--!")
        .when(k % 11 == 0, k.cast("string"))
        .when(k % 7 == 0, F.concat(F.upper("lang"), F.lit(".")))
        .when(k % 61 == 0, F.concat("source", "source", "source"))
        .otherwise(F.col("lang"))
    )
    return integrity_suite.integrity_suite(rows.select("doc_id", "source", "lang", "n_chars", "quality", tag.alias("tag")), "quality", ["doc_id"])
