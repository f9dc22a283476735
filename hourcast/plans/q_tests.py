"""Wave 4 queries: average ranks, Spearman, Pearson to target, correlation pairs, Kruskal-Wallis,
Jarque-Bera, high-correlation drop, feature selection. Oracles check r, t, H, JB, the t tail by finite
sums, the chi-square tail by its closed form, and the selection against critical values."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourcast.operators import significance as st
from hourcast.operators.profile import to_long
from hourcast.operators.ranks import average_ranks
from hourcast.plans import adapters as ad
from hourcast.plans.catalog import register, sql_norm
from hourcast.schema import FIXED_EXCLUDE_COLUMNS, LEADING_COLUMNS, RAW_SCHEMA, numeric_columns

WIDE = ad.with_ctes("obs_wide")
LI_FEATS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
LI_TARGET = "l_extendedprice"
OBS_FEATS = numeric_columns(RAW_SCHEMA, exclude=("Temperature",))


def _qc(cols):
    return ", ".join(f'"{c}"' for c in cols)


def _avg_rank_sql(part: str, order: str) -> str:
    p = f"PARTITION BY {part} " if part else ""
    pv = f"PARTITION BY {part + ', ' if part else ''}{order}"
    return f"(rank() OVER ({p}ORDER BY {order}) + (count(*) OVER ({pv}) - 1) / 2.0)"


@register("avg_rank", oracle=sql_norm(
    f"""SELECT "column", value, count(*) AS cnt, min(r) AS rank FROM (
  SELECT "column", value, {_avg_rank_sql('"column"', 'value')} AS r
  FROM (FROM (SELECT l_quantity, l_extendedprice, l_discount FROM lineitem) UNPIVOT (value FOR "column" IN (l_quantity, l_extendedprice, l_discount))))
GROUP BY 1, 2""", doubles=["value", "rank"], ints=["cnt"]))
def q_avg_rank(spark, sf_dir):
    li = ad.read(spark, sf_dir, "lineitem")
    long = to_long(li, ["l_quantity", "l_extendedprice", "l_discount"])
    return average_ranks(long, ["column"]).select("column", "value", "cnt", "rank")


def spearman_sql(src: str, target: str, feats, with_: str = "", raw: bool = False) -> str:
    casted = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in feats)
    rt = _avg_rank_sql("y IS NULL", "y")
    rf = _avg_rank_sql('"column", value IS NULL', "value")
    inner = f"""SELECT "column" AS "Feature",
       CASE WHEN count_if(value IS NULL) = 0 AND count_if(y IS NULL) = 0
            THEN covar_pop(rf, rt) / nullif(stddev_pop(rf) * stddev_pop(rt), 0) END AS "Correlation",
       count(*) AS n
FROM (SELECT *, CASE WHEN value IS NOT NULL THEN {rf} END AS rf
      FROM (FROM (SELECT *, CASE WHEN y IS NOT NULL THEN {rt} END AS rt
                  FROM (SELECT CAST("{target}" AS DOUBLE) AS y, {casted} FROM {src}))
            UNPIVOT INCLUDE NULLS (value FOR "column" IN ({_qc(feats)}))))
GROUP BY 1"""
    outer = f"""SELECT "Feature", "Correlation", n,
       "Correlation" * sqrt((n - 2) / ((1 - "Correlation") * (1 + "Correlation"))) AS t FROM ({inner})"""
    return outer if raw else sql_norm(outer, doubles=["Correlation", "t"], ints=["n"], with_=with_)


def _t_tail_sql(rows: str) -> str:
    """``rows`` (with t and n) and the two-sided p of Student t with n - 2 degrees of freedom, by its finite sums
    in cos(theta), theta = atan(|t| / sqrt(df)): one for even and one for odd degrees of freedom."""
    return f"""WITH s AS (SELECT *, n - 2 AS df, atan(abs(t) / sqrt(n - 2)) AS th FROM ({rows})),
d AS (SELECT DISTINCT df FROM s),
k AS (SELECT df, k, sum(CASE WHEN k = 0 THEN 0 WHEN df % 2 = 0 THEN ln((2 * k - 1) / (2.0 * k)) ELSE ln((2 * k) / (2.0 * k + 1)) END)
        OVER (PARTITION BY df ORDER BY k) AS lc FROM (SELECT df, unnest(range(0, CAST(CASE WHEN df % 2 = 0 THEN df // 2 ELSE (df - 1) // 2 END AS BIGINT))) AS k FROM d)),
a AS (SELECT "Feature" AS f, sum(exp(lc + 2 * k * ln(cos(th)))) AS z FROM s JOIN k USING (df) GROUP BY 1)
SELECT "Feature", "Correlation", s.n, t, CASE WHEN df % 2 = 0 THEN 1 - sin(th) * z ELSE 1 - 2 / pi() * (th + sin(th) * cos(th) * z) END AS "P-value"
FROM s LEFT JOIN a ON a.f = s."Feature" """


@register("spearman", oracle=spearman_sql("lineitem", LI_TARGET, LI_FEATS))
def q_spearman(spark, sf_dir):
    return st.spearman(ad.read(spark, sf_dir, "lineitem"), LI_TARGET, LI_FEATS)


@register("spearman_observations", oracle=spearman_sql("obs_wide", "Temperature", OBS_FEATS, WIDE))
def q_spearman_observations(spark, sf_dir):
    """A12 over 41 observation columns: nulls give a null rho, as pandas propagates NaN."""
    return st.spearman(ad.obs_wide(spark, sf_dir), "Temperature", OBS_FEATS)


@register("spearman_test", oracle=sql_norm("SELECT * FROM (" + _t_tail_sql(spearman_sql("lineitem", LI_TARGET, LI_FEATS, raw=True)) + ")",
                                           doubles=["Correlation", "t", "P-value"], ints=["n"]))
def q_spearman_test(spark, sf_dir):
    return st.spearman_test(ad.read(spark, sf_dir, "lineitem"), LI_TARGET, LI_FEATS)


@register("pearson_target", oracle=sql_norm("\nUNION ALL ".join(
    f"""SELECT * FROM (SELECT '{c}' AS "column", covar_pop(CAST("{c}" AS DOUBLE), {LI_TARGET}) /
        nullif(stddev_pop(CAST("{c}" AS DOUBLE)) * stddev_pop({LI_TARGET}), 0) AS r FROM lineitem) WHERE abs(r) >= 0.0"""
    for c in LI_FEATS), doubles=["r"]))
def q_pearson_target(spark, sf_dir):
    return st.pearson_with_target(ad.read(spark, sf_dir, "lineitem"), LI_TARGET, LI_FEATS, threshold=0.0)


PAIR_FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "qty_x2"]


def _li_pairs(spark, sf_dir):
    li = ad.read(spark, sf_dir, "lineitem")
    return li.withColumn("qty_x2", F.col("l_quantity") * 2 + 1)


def _pairs_sql(rank: bool) -> str:
    src = "(SELECT *, l_quantity * 2 + 1 AS qty_x2 FROM lineitem)"
    if rank:
        cols = ", ".join(f'{_avg_rank_sql("", c)} AS "{c}"' for c in PAIR_FEATS)
        src = f"(SELECT {cols} FROM {src})"
    parts = []
    for i, a in enumerate(PAIR_FEATS):
        for j in range(i + 1, len(PAIR_FEATS)):
            b = PAIR_FEATS[j]
            parts.append(f"""SELECT '{a}' AS f1, '{b}' AS f2, {i} AS i1, {j} AS i2,
       covar_pop("{a}", "{b}") / nullif(stddev_pop("{a}") * stddev_pop("{b}"), 0) AS r FROM {src}""")
    return "\nUNION ALL ".join(parts)


@register("corr_pairs", oracle=sql_norm(_pairs_sql(False), doubles=["r"], ints=["i1", "i2"]))
def q_corr_pairs(spark, sf_dir):
    return st.corr_matrix(_li_pairs(spark, sf_dir), PAIR_FEATS, "pearson")


@register("corr_pairs_spearman", oracle=sql_norm(_pairs_sql(True), doubles=["r"], ints=["i1", "i2"]))
def q_corr_pairs_spearman(spark, sf_dir):
    return st.corr_matrix(_li_pairs(spark, sf_dir), PAIR_FEATS, "spearman")


@register("high_corr_drop", oracle=sql_norm(f"""
WITH src AS (SELECT *, l_quantity * 2 + 1 AS qty_x2 FROM lineitem),
rk AS (SELECT {", ".join(f'{_avg_rank_sql("", c)} AS "{c}"' for c in ["l_extendedprice"] + [c for c in PAIR_FEATS if c != "l_extendedprice"])} FROM src),
pairs AS ({_pairs_sql(True).replace("FROM (SELECT", "FROM (SELECT", 1)}),
ct AS ({" UNION ALL ".join(f"SELECT '{c}' AS f, abs(covar_pop(\"{c}\", l_extendedprice) / nullif(stddev_pop(\"{c}\") * stddev_pop(l_extendedprice), 0)) AS ct FROM rk" for c in PAIR_FEATS if c != "l_extendedprice")})
SELECT DISTINCT CASE WHEN coalesce(a.ct >= b.ct - 1e-12, false) THEN p.f2 ELSE p.f1 END AS "Feature"
FROM pairs p LEFT JOIN ct a ON a.f = p.f1 LEFT JOIN ct b ON b.f = p.f2
WHERE abs(p.r) > 0.95 AND p.f1 <> 'l_extendedprice' AND p.f2 <> 'l_extendedprice'"""))
def q_high_corr_drop(spark, sf_dir):
    feats = [c for c in PAIR_FEATS if c != "l_extendedprice"]
    return st.high_corr_drop(_li_pairs(spark, sf_dir), "l_extendedprice", feats, 0.95, "spearman")


def kruskal_sql(src: str, target: str, feats, with_: str = "", with_p: bool = False) -> str:
    cols = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in feats)
    pre = (with_ + ",\n" if with_ else "WITH ")
    body = pre + f"""long AS (FROM (SELECT CAST("{target}" AS DOUBLE) AS y, {cols} FROM {src} WHERE "{target}" IS NOT NULL)
             UNPIVOT (grp FOR "column" IN ({_qc(feats)}))),
sz AS (SELECT "column", grp FROM long GROUP BY 1, 2 HAVING count(*) >= 5),
kept AS (SELECT l.* FROM long l SEMI JOIN sz ON l."column" = sz."column" AND l.grp = sz.grp),
rk AS (SELECT *, {_avg_rank_sql('"column"', 'y')} AS r FROM kept),
ties AS (SELECT "column", sum(c * c * c - c) AS tt FROM (SELECT "column", y, CAST(count(*) AS DOUBLE) AS c FROM kept GROUP BY 1, 2) GROUP BY 1),
g AS (SELECT "column", grp, sum(r) AS rj, count(*) AS nj FROM rk GROUP BY 1, 2),
per AS (SELECT "column", CAST(sum(nj) AS DOUBLE) AS nn, count(*) AS k, sum(rj * rj / nj) AS s FROM g GROUP BY 1 HAVING count(*) >= 2),
hs AS (SELECT "column" AS feature,
       (12.0 / (nn * (nn + 1)) * s - 3.0 * (nn + 1)) / nullif(1 - tt / (nn * nn * nn - nn), 0) AS "H-statistic",
       k, nn AS "N" FROM per JOIN ties USING ("column"))"""
    if with_p:
        return sql_norm(f'SELECT *, {_chi2_sf_even_sql(chr(34) + "H-statistic" + chr(34), "k")} AS "p-value" FROM hs',
                        doubles=["H-statistic", "p-value"], ints=["k", "N"], with_=body)
    return sql_norm("SELECT * FROM hs", doubles=["H-statistic"], ints=["k", "N"], with_=body)


def _chi2_sf_even_sql(x: str, k: str, max_df: int = 12) -> str:
    """Chi-square upper tail for even degrees of freedom: exp(-x/2) * sum_{i < df/2} (x/2)^i / i!."""
    import math
    whens = []
    for df in range(2, max_df + 1, 2):
        terms = " + ".join(f"power({x} / 2.0, {i}) / {float(math.factorial(i))}" for i in range(df // 2))
        whens.append(f"WHEN {k} - 1 = {df} THEN exp(-{x} / 2.0) * ({terms})")
    return "CASE " + " ".join(whens) + " END"


ORD_CATS = ["o_orderpriority", "o_orderstatus"]


@register("kruskal", oracle=kruskal_sql("orders", "o_totalprice", ORD_CATS))
def q_kruskal(spark, sf_dir):
    return st.kruskal(ad.read(spark, sf_dir, "orders"), "o_totalprice", ORD_CATS)


OBS_CATS = ["StationID", "WeatherCode", "CloudType"]


@register("kruskal_observations", oracle=kruskal_sql("obs_wide", "Temperature", OBS_CATS, WIDE))
def q_kruskal_observations(spark, sf_dir):
    return st.kruskal(ad.obs_wide(spark, sf_dir), "Temperature", OBS_CATS)


@register("kruskal_test", oracle=kruskal_sql("orders", "o_totalprice", ORD_CATS, with_p=True))
def q_kruskal_test(spark, sf_dir):
    return st.kruskal_test(ad.read(spark, sf_dir, "orders"), "o_totalprice", ORD_CATS)


def jb_sql(src: str, feats, with_: str = "", with_p: bool = False) -> str:
    casted = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in feats)
    pre = (with_ + ",\n" if with_ else "WITH ")
    body = pre + f"""long AS (FROM (SELECT {casted} FROM {src}) UNPIVOT (value FOR "column" IN ({_qc(feats)}))),
mu AS (SELECT "column", avg(value) AS m FROM long GROUP BY 1),
mom AS (SELECT l."column", count(*) AS n, avg(power(value - m, 2)) AS m2, avg(power(value - m, 3)) AS m3,
               avg(power(value - m, 4)) AS m4 FROM long l JOIN mu ON l."column" = mu."column" GROUP BY 1),
sk AS (SELECT "column", n, m3 / power(nullif(m2, 0), 1.5) AS skew, m4 / power(nullif(m2, 0), 2) - 3 AS kurt FROM mom),
jb AS (SELECT "column", n, skew, kurt, n / 6.0 * (skew * skew + kurt * kurt / 4.0) AS "JB" FROM sk)"""
    if with_p:
        return sql_norm("""SELECT *, exp(-"JB" / 2.0) AS "p-value", coalesce(exp(-"JB" / 2.0) > 0.05, false) AS normal FROM jb""",
                        doubles=["skew", "kurt", "JB", "p-value"], ints=["n"], with_=body)
    return sql_norm("SELECT * FROM jb", doubles=["skew", "kurt", "JB"], ints=["n"], with_=body)


@register("jarque_bera", oracle=jb_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
def q_jarque_bera(spark, sf_dir):
    return st.jarque_bera(ad.read(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@register("jarque_bera_observations", oracle=jb_sql("obs_wide", numeric_columns(RAW_SCHEMA), WIDE))
def q_jarque_bera_observations(spark, sf_dir):
    return st.jarque_bera(ad.obs_wide(spark, sf_dir), numeric_columns(RAW_SCHEMA))


@register("normality_test", oracle=jb_sql("obs_wide", numeric_columns(RAW_SCHEMA), WIDE, with_p=True))
def q_normality_test(spark, sf_dir):
    return st.normality_test(ad.obs_wide(spark, sf_dir), numeric_columns(RAW_SCHEMA))


def ad_sql(src: str, feats, with_: str = "") -> str:
    """Anderson-Darling over ranked rows, one row at a time."""
    casted = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in feats)

    def poly(coefficients):
        out = str(coefficients[0])
        for c in coefficients[1:]:
            out = f"({out} * x + {c})"
        return out

    def p(bound, c0, c1, c2, upper):
        e = f"exp({c0} + {c1} * a + {c2} * a * a)"
        return f"WHEN a >= {bound} THEN " + (f"1 - {e}" if upper else f"least(1.0, {e})")

    pre = (with_ + ",\n" if with_ else "WITH ")
    body = pre + f"""long AS (FROM (SELECT {casted} FROM {src}) UNPIVOT (value FOR "column" IN ({_qc(feats)}))),
zs AS (SELECT "column", row_number() OVER (PARTITION BY "column" ORDER BY value) AS i, count(*) OVER (PARTITION BY "column") AS n,
         (value - avg(value) OVER (PARTITION BY "column")) / nullif(stddev_samp(value) OVER (PARTITION BY "column"), 0) AS z FROM long),
xs AS (SELECT *, abs(z) AS x FROM zs),
tails AS (SELECT *, -x * x / 2 + ln(CASE WHEN x < {st.TAIL_BOUND} THEN {poly(st.TAIL_NUMERATOR)} / {poly(st.TAIL_DENOMINATOR)}
    ELSE 1 / ((x + 1 / (x + 2 / (x + 3 / (x + 4 / (x + 0.65))))) * {st.ROOT_TWO_PI}) END) AS t FROM xs),
logs AS (SELECT *, CASE WHEN z <= 0 THEN t ELSE ln(1 - exp(t)) END AS below, CASE WHEN z >= 0 THEN t ELSE ln(1 - exp(t)) END AS above FROM tails),
a2 AS (SELECT "column", n, CASE WHEN n >= 8 THEN -n - sum((2 * i - 1) * below + (2 * (n + 1 - i) - 1) * above) / n END AS "A2" FROM logs GROUP BY 1, 2),
st AS (SELECT *, "A2" * (1 + 0.75 / n + 2.25 / (n * n)) AS a FROM a2),
ps AS (SELECT *, CASE WHEN a > 150 THEN 0.0 {" ".join(p(*r) for r in st.AD_P)} WHEN a < 0 THEN 1.0 END AS pv FROM st)"""
    return sql_norm('SELECT "column", n, "A2", a AS "statistic", pv AS "p-value", coalesce(pv > 0.05, false) AS normal FROM ps',
                    doubles=["A2", "statistic", "p-value"], ints=["n"], with_=body)


AD_FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("anderson_darling", oracle=ad_sql("lineitem", AD_FEATS))
def q_anderson_darling(spark, sf_dir):
    """Normality from order statistics, positions by bucketed counts."""
    return st.anderson_darling(ad.read(spark, sf_dir, "lineitem"), AD_FEATS)


@register("anderson_darling_observations", oracle=ad_sql("obs_wide", ["Temperature", "GustTime", "LocalPressure", "Visibility"], WIDE))
def q_anderson_darling_observations(spark, sf_dir):
    return st.anderson_darling(ad.obs_wide(spark, sf_dir), ["Temperature", "GustTime", "LocalPressure", "Visibility"])


# Upper 5 % points of chi-square for 1 to 12 degrees of freedom, and of the normal, two-sided.
CHI2_95 = (3.841459, 5.991465, 7.814728, 9.487729, 11.070498, 12.591587, 14.067140, 15.507313, 16.918978, 18.307038, 19.675138, 21.026070)
NORMAL_95 = 1.959963985


def _selection_sql() -> str:
    """Decisions of both tests against critical values, then the columns that stay in order and those that go."""
    parts = ["year", "month", "day", "hour"]
    columns = [f.name for f in RAW_SCHEMA.fields]
    columns += [p for p in parts if p not in columns]
    feats = [c for c in [*numeric_columns(RAW_SCHEMA, exclude=("Temperature",)), *parts] if c in columns]
    feats = list(dict.fromkeys(feats))
    order = [c for c in LEADING_COLUMNS if c in columns] + [c for c in columns if c not in LEADING_COLUMNS]
    values = ", ".join(f"('{c}', {i}, {str(c in LEADING_COLUMNS).lower()}, {str(c in FIXED_EXCLUDE_COLUMNS).lower()})" for i, c in enumerate(order))
    crit = " ".join(f"WHEN {i + 1} THEN {v}" for i, v in enumerate(CHI2_95))
    kw = kruskal_sql("obs_wide", "Temperature", OBS_CATS, WIDE)
    body = kw[:kw.rindex("SELECT * REPLACE")].rstrip()
    return f"""{body},
sp AS ({spearman_sql("obs_wide", "Temperature", feats, raw=True)}),
gone AS (SELECT "Feature" AS c FROM sp WHERE abs(t) <= {NORMAL_95} + ({NORMAL_95} ** 3 + {NORMAL_95}) / (4.0 * (n - 2))
         UNION SELECT feature FROM hs WHERE "H-statistic" <= CASE k - 1 {crit} END),
cols AS (SELECT * FROM (VALUES {values}) v(c, i, safe, fixed)),
marked AS (SELECT c, i, safe OR NOT (fixed OR c IN (SELECT c FROM gone)) AS kept FROM cols)
SELECT CASE WHEN kept THEN CAST(row_number() OVER (PARTITION BY kept ORDER BY i) - 1 AS BIGINT) END AS position, c AS "column", kept, CAST(NULL AS BIGINT) AS n_rows FROM marked
UNION ALL SELECT NULL, '__rows__', true, count(*) FROM obs_wide"""


@register("feature_selection", oracle=_selection_sql())
def q_feature_selection(spark, sf_dir):
    """M1 on the observations: drop insignificant and fixed columns, leading columns first."""
    df = ad.obs_wide(spark, sf_dir).drop("event_id")
    kept, dropped = st.feature_selection(df, "Temperature", FIXED_EXCLUDE_COLUMNS, LEADING_COLUMNS)
    rows = [(i, c, True) for i, c in enumerate(kept.columns)] + [(None, c, False) for c in dropped]
    counts = kept.agg(F.count(F.lit(1)).alias("n_rows"))
    meta = spark.createDataFrame(rows, "position int, column string, kept boolean")
    return meta.withColumn("n_rows", F.lit(None).cast("long")).unionByName(
        counts.select(F.lit(None).cast("int").alias("position"), F.lit("__rows__").alias("column"),
                      F.lit(True).alias("kept"), "n_rows"))
