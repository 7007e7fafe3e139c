"""Split, fold, sampling, encoding, scaling and weighting queries (D1-D13) on ``tab``."""

from __future__ import annotations

from pyspark.sql import functions as F

from strideframe.functions.hashing import sql_bucket, sql_hash60
from strideframe.operators import prep, splits
from strideframe.plans.catalog import register, with_ctes
from strideframe.plans.derived import SQL_MATRIX_LONG, SQL_TAB, TAB_COLUMNS, tab
from strideframe.plans.selection import sql_neighbours

SEED = 42
VAL, TEST = 0.15, 0.15
VAL_OF_REST = VAL / (1 - TEST)
K_FOLDS = 5
SAMPLE_N = 3000


def _d(x: float) -> str:
    """A DuckDB double literal (plain ``0.15`` would be an exact DECIMAL)."""
    return f"CAST({x!r} AS DOUBLE)"


def _h(col: str, seed=SEED) -> str:
    return f"(('0x' || substr(md5(CAST({col} AS VARCHAR) || ':{seed}'), 1, 8))::UBIGINT)"


SQL_SPLIT = f"""split AS (
  SELECT row_id, class, grp, {", ".join(TAB_COLUMNS)},
         CASE WHEN rk < ceil(n * {_d(TEST)}) THEN 'test'
              WHEN rk < ceil(n * {_d(TEST)}) + ceil((n - ceil(n * {_d(TEST)})) * {_d(VAL_OF_REST)}) THEN 'val'
              ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY class ORDER BY {_h("row_id")}, row_id) - 1 AS rk,
               count(*) OVER (PARTITION BY class) AS n FROM tab))"""


def split_tab(spark, d):
    return splits.stratified_split(tab(spark, d), "row_id", "class", VAL, TEST, SEED)


@register("d1_stratified_split", with_ctes(SQL_TAB, SQL_SPLIT) + "SELECT row_id, class, split FROM split")
def d1_stratified_split(spark, d):
    return split_tab(spark, d).select("row_id", "class", "split")


@register(
    "d2_random_split",
    with_ctes(SQL_TAB)
    + f"""SELECT row_id, class, CASE WHEN {sql_hash60("row_id", SEED)} < {splits.share_cuts(TEST, VAL)[0]} THEN 'test'
                              WHEN {sql_hash60("row_id", SEED)} < {splits.share_cuts(TEST, VAL)[1]} THEN 'val' ELSE 'train' END AS split FROM tab""",
)
def d2_random_split(spark, d):
    return splits.stratified_split(tab(spark, d), "row_id", "class", VAL, TEST, SEED, stratify=False).select(
        "row_id", "class", "split"
    )


SQL_GROUPS = f"""gsplit AS (
  SELECT grp, CASE WHEN rk < greatest(floor(g * {_d(0.2)}), 1) THEN 'test'
                   WHEN rk < greatest(floor(g * {_d(0.2)}), 1)
                             + greatest(floor((g - greatest(floor(g * {_d(0.2)}), 1)) * {_d(0.2)}), 1) THEN 'val'
                   ELSE 'train' END AS split
  FROM (SELECT grp, row_number() OVER (ORDER BY {_h("grp")}, grp) - 1 AS rk, count(*) OVER () AS g
        FROM (SELECT DISTINCT grp FROM tab)))"""


def group_split_tab(spark, d):
    return splits.group_split(tab(spark, d), "grp", 0.2, 0.2, SEED)


@register(
    "d3_group_split",
    with_ctes(SQL_TAB, SQL_GROUPS) + "SELECT t.row_id, t.grp, g.split FROM tab t JOIN gsplit g USING (grp)",
)
def d3_group_split(spark, d):
    return group_split_tab(spark, d).select("row_id", "grp", "split")


@register(
    "d4_membership",
    with_ctes(SQL_TAB, SQL_GROUPS)
    + """SELECT row_id, grp, 'in' AS member FROM tab WHERE grp IN (SELECT grp FROM gsplit WHERE split = 'test')
UNION ALL
SELECT row_id, grp, 'out' AS member FROM tab WHERE grp NOT IN (SELECT grp FROM gsplit WHERE split = 'test')""",
)
def d4_membership(spark, d):
    t = tab(spark, d).select("row_id", "grp")
    test_groups = splits.group_table(t, "grp", 0.2, 0.2, SEED).filter(F.col("split") == "test").select("grp")
    return splits.with_membership(t, test_groups, "grp").select("row_id", "grp", F.when(F.col("is_member"), "in").otherwise("out").alias("member"))


@register(
    "d5_label_encoding",
    with_ctes(SQL_TAB)
    + "SELECT row_id, class, CAST(dense_rank() OVER (ORDER BY class) - 1 AS INTEGER) AS label_idx FROM tab",
)
def d5_label_encoding(spark, d):
    return prep.encode_labels(tab(spark, d), "class").select("row_id", "class", "label_idx")


@register(
    "d6_label_decoding",
    with_ctes(SQL_TAB)
    + """SELECT row_id, CAST(dense_rank() OVER (ORDER BY class) - 1 AS INTEGER) AS label_idx, class AS class_decoded
FROM tab""",
)
def d6_label_decoding(spark, d):
    t = tab(spark, d)
    model = prep.fit_label_encoder(t, "class")
    enc = model.transform(t).select("row_id", "label_idx")
    return prep.decode_labels(enc, "label_idx", list(model.labels), "class_decoded")


def _scaled_sql(method: str) -> str:
    if method == "standard":
        params = ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS b_{c}" for c in TAB_COLUMNS)
    else:
        params = ", ".join(f"min({c}) AS a_{c}, max({c}) - min({c}) AS b_{c}" for c in TAB_COLUMNS)
    cols = ", ".join(
        f"CASE WHEN p.b_{c} = 0 THEN s.{c} - p.a_{c} ELSE (s.{c} - p.a_{c}) / p.b_{c} END AS {c}" for c in TAB_COLUMNS
    )
    return (
        with_ctes(SQL_TAB, SQL_SPLIT, f"p AS (SELECT {params} FROM split WHERE split = 'train')")
        + f"SELECT s.row_id, s.split, {cols} FROM split s, p"
    )


@register("d7_standard_scaling", _scaled_sql("standard"), floats=TAB_COLUMNS)
def d7_standard_scaling(spark, d):
    return prep.scale_by_split(split_tab(spark, d), TAB_COLUMNS, "standard").select("row_id", "split", *TAB_COLUMNS)


@register("d8_minmax_scaling", _scaled_sql("minmax"), floats=TAB_COLUMNS)
def d8_minmax_scaling(spark, d):
    return prep.scale_by_split(split_tab(spark, d), TAB_COLUMNS, "minmax").select("row_id", "split", *TAB_COLUMNS)


SQL_WEIGHTS = """cw AS (
  SELECT class, count, CAST(sum(count) OVER () AS DOUBLE) / (count(*) OVER () * count) AS weight
  FROM (SELECT class, count(*) AS count FROM tab GROUP BY class))"""


@register(
    "d9_class_weights",
    with_ctes(SQL_TAB, SQL_WEIGHTS) + "SELECT class, count, weight, sqrt(weight) AS weight_sqrt FROM cw",
    floats=["weight", "weight_sqrt"],
)
def d9_class_weights(spark, d):
    t = tab(spark, d)
    bal = prep.class_weights(t, "class", "balanced")
    return bal.join(prep.class_weights(t, "class", "sqrt").select("class", F.col("weight").alias("weight_sqrt")), "class")


@register(
    "d10_sample_weights",
    with_ctes(SQL_TAB, SQL_WEIGHTS) + "SELECT t.row_id, t.class, cw.weight FROM tab t LEFT JOIN cw USING (class)",
    floats=["weight"],
)
def d10_sample_weights(spark, d):
    return prep.sample_weights(tab(spark, d), "class").select("row_id", "class", "weight")


@register(
    "d11_balanced_resample",
    with_ctes(
        SQL_TAB,
        f"""ranked AS (
  SELECT row_id, class, row_number() OVER (PARTITION BY class ORDER BY {_h("row_id")}, row_id) - 1 AS rk,
         count(*) OVER (PARTITION BY class) AS n_group FROM tab)""",
        """classes AS (SELECT class, n_group, dense_rank() OVER (ORDER BY class) - 1 AS cls_idx
            FROM (SELECT DISTINCT class, n_group FROM ranked))""",
        f"""draws AS (
  SELECT d.draw, c.class, {sql_hash60("d.draw", SEED)} % c.n_group AS rk
  FROM (SELECT range AS draw FROM range((SELECT count(*) FROM tab))) d
  JOIN classes c ON d.draw % (SELECT count(*) FROM classes) = c.cls_idx)""",
    )
    + "SELECT d.draw, r.row_id, r.class FROM draws d JOIN ranked r ON d.class = r.class AND d.rk = r.rk",
)
def d11_balanced_resample(spark, d):
    return splits.balanced_resample(tab(spark, d), "row_id", "class", seed=SEED).select("draw", "row_id", "class")


@register(
    "d12_sample_n",
    with_ctes(SQL_TAB) + f"SELECT row_id, class FROM tab ORDER BY {_h('row_id')}, row_id LIMIT {SAMPLE_N}",
)
def d12_sample_n(spark, d):
    return splits.sample_n(tab(spark, d), "row_id", SAMPLE_N, SEED).select("row_id", "class")


@register(
    "d13_kfold",
    with_ctes(SQL_TAB)
    + f"""SELECT row_id, class,
       CAST((row_number() OVER (PARTITION BY class ORDER BY {_h("row_id")}, row_id) - 1) % {K_FOLDS} AS INTEGER) AS fold
FROM tab""",
)
def d13_kfold(spark, d):
    return splits.kfold(tab(spark, d), "row_id", "class", K_FOLDS, SEED).select("row_id", "class", "fold")


# ------------------------------------------------------------------ D14
D14_THRESHOLD = 0.1
D14_K = 10


def _wide_embeddings(spark, d):
    from strideframe.plans.derived import table

    e = table(spark, d, "embeddings")
    width = e.select(F.max(F.size("embedding"))).first()[0] or 0
    return e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"f{i}") for i in range(width)])


@register(
    "d14_preprocess_pipeline",
    f"""WITH {SQL_MATRIX_LONG},
corr_m AS (SELECT a.pos AS i, b.pos AS j, corr(a.val, b.val) AS r FROM matrix_long a JOIN matrix_long b USING (vec_id) GROUP BY a.pos, b.pos),
kept AS (SELECT DISTINCT pos FROM matrix_long WHERE pos NOT IN (SELECT j FROM corr_m WHERE i < j AND abs(r) > {D14_THRESHOLD!r})),
{sql_neighbours("'f' || m.pos")},
top AS (SELECT pos FROM knn_mi WHERE pos IN (SELECT pos FROM kept) ORDER BY mi DESC, 'f' || pos LIMIT {D14_K}),
sp AS (
  SELECT vec_id, CASE WHEN rk < ceil(n * {_d(TEST)}) THEN 'test'
                      WHEN rk < ceil(n * {_d(TEST)}) + ceil((n - ceil(n * {_d(TEST)})) * {_d(VAL_OF_REST)}) THEN 'val'
                      ELSE 'train' END AS split
  FROM (SELECT vec_id, row_number() OVER (PARTITION BY label ORDER BY {_h("vec_id")}, vec_id) - 1 AS rk,
               count(*) OVER (PARTITION BY label) AS n FROM embeddings)),
params AS (SELECT pos, avg(val) AS mu, stddev_pop(val) AS sd FROM matrix_long JOIN sp USING (vec_id)
           WHERE split = 'train' AND pos IN (SELECT pos FROM top) GROUP BY pos)
SELECT m.vec_id, sp.split, m.pos, CASE WHEN p.sd = 0 THEN m.val - p.mu ELSE (m.val - p.mu) / p.sd END AS val
FROM matrix_long m JOIN sp USING (vec_id) JOIN params p USING (pos)""",
    floats=["val"],
)
def d14_preprocess_pipeline(spark, d):
    from strideframe.operators.preprocess import Preprocessor
    from strideframe.operators.stats import unpivot

    pre = Preprocessor(normalize=True, remove_correlated=True, correlation_threshold=D14_THRESHOLD, n_select_features=D14_K)
    wide = _wide_embeddings(spark, d)
    feats = [c for c in wide.columns if c not in ("vec_id", "label")]
    out = pre.fit_transform(wide, "vec_id", "label", feats, VAL, TEST, SEED)
    back = pre.inverse_transform_labels(pre.encode_labels(out, "label"), "label_idx", "again")
    long = unpivot(back.where("again = label"), ["vec_id", "split"], pre.selected_features, "feature", "val")
    return long.select("vec_id", "split", F.expr("cast(substring(feature, 2) as int)").alias("pos"), "val")
