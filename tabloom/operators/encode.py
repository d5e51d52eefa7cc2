"""Categorical encoding.

Dictionaries are built as DataFrames (distinct values numbered by the
distributed ``dense_ids``) and joined back; the join is broadcast by
adaptive execution when the dictionary is measured small.  Only
``one_hot`` brings values to the driver, because it must create one
column per value — it refuses domains larger than ``max_values``.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import portable_hash
from .joins import attach_row
from .ranking import dense_ids, row_number_by

NULL_TEXT = "nan"


def dictionary(df: DataFrame, col: str, null_text: str | None = NULL_TEXT, start: int = 0) -> DataFrame:
    """(value, code): sorted distinct values numbered start.. (LabelEncoder fit)."""
    v = F.coalesce(F.col(col).cast("string"), F.lit(null_text)) if null_text is not None else F.col(col)
    return dense_ids(df.select(v.alias("_v")), "_v", out="_code", start=start)


def label_encode(df: DataFrame, cols: Sequence[str], null_text: str = NULL_TEXT, suffix: str = "") -> DataFrame:
    """Replace each column with its code in the sorted distinct values (NULL as text)."""
    out = df
    for c in cols:
        d = dictionary(df, c, null_text)
        key = F.coalesce(F.col(c).cast("string"), F.lit(null_text))
        out = (out.withColumn("_v", key).join(d, "_v", "left")
               .withColumn(c + suffix, F.col("_code").cast("int")).drop("_v", "_code"))
    return out


def category_codes(df: DataFrame, cols: Sequence[str], null_code: int = -1, suffix: str = "") -> DataFrame:
    """Sorted category codes with NULL → ``null_code`` (pandas ``cat.codes``)."""
    out = df
    for c in cols:
        d = dense_ids(df.select(F.col(c).alias("_v")), "_v", out="_code", start=0)
        out = (out.join(d, out[c].eqNullSafe(d["_v"]) & d["_v"].isNotNull(), "left")
               .withColumn(c + suffix, F.coalesce(F.col("_code"), F.lit(null_code)).cast("int"))
               .drop("_v", "_code"))
    return out


def factorize(df: DataFrame, col: str, order: Sequence[str], null_code: int = -1, out: str | None = None) -> DataFrame:
    """Codes in order of first appearance along ``order`` (``pd.factorize``)."""
    first = (df.where(F.col(col).isNotNull())
             .groupBy(F.col(col).alias("_v")).agg(F.min(F.struct(*order)).alias("_first")))
    codes = row_number_by(first, None, ["_first", "_v"], out="_code").select("_v", (F.col("_code") - 1).alias("_code"))
    return (df.join(codes, df[col] == codes["_v"], "left")
            .withColumn(out or col, F.coalesce(F.col("_code"), F.lit(null_code)).cast("int"))
            .drop("_v", "_code"))


def distinct_values(df: DataFrame, col: str, max_values: int = 1000) -> list:
    """Sorted distinct non-NULL values; raises when more than ``max_values``."""
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().limit(max_values + 1).collect()
    if len(rows) > max_values:
        raise ValueError(f"{col} has more than {max_values} distinct values: use hash_encode")
    return sorted(r[0] for r in rows)


def one_hot(df: DataFrame, cols: Sequence[str], null_as_category: bool = True,
            max_values: int = 1000, values: dict | None = None, drop: bool = True) -> tuple[DataFrame, list[str]]:
    """One 0/1 column ``{col}_{value}`` per value; NULL → ``{col}_nan``.

    Returns (DataFrame, new column names).
    """
    new, exprs = [], {}
    for c in cols:
        vals = (values or {}).get(c) or distinct_values(df, c, max_values)
        for v in vals:
            n = f"{c}_{v}"
            exprs[n] = F.coalesce(F.col(c) == F.lit(v), F.lit(False)).cast("int")
            new.append(n)
        if null_as_category:
            n = f"{c}_{NULL_TEXT}"
            exprs[n] = F.col(c).isNull().cast("int")
            new.append(n)
    taken = [n for n in new if n in set(df.columns) - set(cols if drop else [])]
    clashes = sorted({n for n in new if new.count(n) > 1} | set(taken))
    if clashes:
        raise ValueError(f"several values give the same column name: {clashes}; rename columns or values first")
    out = df.withColumns(exprs)
    return (out.drop(*cols) if drop else out), new


def one_hot_vector(df: DataFrame, cols: Sequence[str], out: str = "onehot") -> DataFrame:
    """MLlib StringIndexer + OneHotEncoder → one sparse vector column."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep",
                         stringOrderType="alphabetAsc") for c in cols]
    enc = OneHotEncoder(inputCols=[f"{c}__idx" for c in cols], outputCols=[f"{c}__oh" for c in cols],
                        handleInvalid="keep")
    asm = VectorAssembler(inputCols=[f"{c}__oh" for c in cols], outputCol=out)
    model = Pipeline(stages=[*idx, enc, asm]).fit(df)
    res = model.transform(df)
    return res.drop(*[f"{c}__idx" for c in cols], *[f"{c}__oh" for c in cols])


def hash_bucket(col_name: str, c, buckets: int):
    """Portable hashing-trick bucket of ``name=value``."""
    return portable_hash(F.concat(F.lit(col_name + "="), F.coalesce(c.cast("string"), F.lit(NULL_TEXT)))) % buckets


def hash_encode(df: DataFrame, cols: Sequence[str], buckets: int = 3000, suffix: str = "_hash") -> DataFrame:
    """Hashing trick with a portable hash: one bucket index per column."""
    return df.withColumns({f"{c}{suffix}": hash_bucket(c, F.col(c), buckets) for c in cols})


def hash_vector(df: DataFrame, cols: Sequence[str], buckets: int = 3000, out: str = "hashed") -> DataFrame:
    """MLlib FeatureHasher over string columns → sparse vector."""
    from pyspark.ml.feature import FeatureHasher
    return FeatureHasher(inputCols=list(cols), outputCol=out, numFeatures=buckets).transform(df)


def target_mean_max(df: DataFrame, cols: Sequence[str], target: str, apply_to: DataFrame | None = None,
                    suffix: str = "_target") -> DataFrame:
    """Mean target per category ÷ max of the category means; unseen → mean of means."""
    out = apply_to if apply_to is not None else df
    for c in cols:
        m = df.groupBy(F.col(c).alias("_v")).agg(F.avg(target).alias("_m"))
        s = m.agg(F.max("_m").alias("_mx"), F.avg("_m").alias("_mm"))
        rel = attach_row(m, s).select("_v", F.try_divide(F.col("_m"), F.col("_mx")).alias("_rel"))
        out = attach_row(out.join(rel, out[c] == F.col("_v"), "left").drop("_v"), s.select("_mm"))
        out = out.withColumn(c + suffix, F.coalesce(F.col("_rel"), F.col("_mm"))).drop("_rel", "_mm")
    return out


def target_encode(train: DataFrame, test: DataFrame, col: str, target: str, min_samples_leaf: int = 1,
                  smoothing: float = 1.0, out: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Smoothed target mean ``prior·(1-s) + mean·s``, s = sigmoid((n - min_leaf)/smoothing).

    Fitted on ``train`` only; categories unseen in train get the prior.
    The one-row prior is broadcast (its size is fixed).
    """
    out = out or f"{col}_te"
    prior = train.agg(F.avg(target).alias("_prior"))
    st = train.groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_n"), F.avg(target).alias("_m"))
    s = 1 / (1 + F.exp(-(F.col("_n") - F.lit(min_samples_leaf)) / F.lit(float(smoothing))))
    enc = attach_row(st, prior).select("_v", (F.col("_prior") * (1 - s) + F.col("_m") * s).alias("_enc"))

    def apply(df):
        j = attach_row(df.join(enc, df[col] == F.col("_v"), "left").drop("_v"), prior)
        return j.withColumn(out, F.coalesce(F.col("_enc"), F.col("_prior"))).drop("_enc", "_prior")
    return apply(train), apply(test)


def target_encode_oof(df: DataFrame, col: str, target: str, fold: str, min_samples_leaf: int = 1, smoothing: float = 1.0,
                      noise_level: float = 0.0, id_col: str | None = None, seed: int = 0, out: str | None = None) -> DataFrame:
    """Smoothed target mean of each row's category over the *other* folds, so no row sees its own target.

    One aggregation by (category, fold); a fold's statistics are the totals
    less its own, nothing is fitted per fold.  The prior of a fold is the mean
    target of the others.  Rows with a NULL category or fold, and categories
    that no other fold has, get the prior (of all rows for a NULL fold).  With
    ``noise_level`` the result is multiplied by ``1 + level * N(0, 1)``, which
    depends on (``seed``, ``id_col``) only.
    """
    out = out or f"{col}_te"
    y = F.col(target).cast("double")
    st = df.where(F.col(fold).isNotNull()).groupBy(F.col(col).alias("_v"), F.col(fold).alias("_f")).agg(F.count(y).alias("_n"), F.sum(y).alias("_s"))
    every = df.agg(F.count(y).alias("_N"), F.sum(y).alias("_S"))
    per_fold = st.groupBy("_f").agg(F.sum("_n").alias("_fn"), F.sum("_s").alias("_fs"))
    prior = attach_row(per_fold, every).select("_f", F.try_divide(F.col("_S") - F.coalesce("_fs", F.lit(0.0)), F.col("_N") - F.col("_fn")).alias("_prior"))
    whole = st.where(F.col("_v").isNotNull()).groupBy("_v").agg(F.sum("_n").alias("_vn"), F.sum("_s").alias("_vs"))
    other = st.join(whole, "_v").select("_v", "_f", (F.col("_vn") - F.col("_n")).alias("_n"), (F.coalesce("_vs", F.lit(0.0)) - F.coalesce("_s", F.lit(0.0))).alias("_s"))
    s = 1 / (1 + F.exp(-(F.col("_n") - F.lit(min_samples_leaf)) / F.lit(float(smoothing))))
    enc = other.where("_n > 0").join(prior, "_f").select("_v", "_f", (F.col("_prior") * (1 - s) + F.col("_s") / F.col("_n") * s).alias("_enc"))
    j = df.join(enc, (F.col(col) == F.col("_v")) & (F.col(fold) == F.col("_f")), "left").drop("_v", "_f").join(prior, F.col(fold) == F.col("_f"), "left").drop("_f")
    j = attach_row(j, every.select(F.try_divide("_S", "_N").alias("_mean")))
    j = j.withColumn(out, F.coalesce("_enc", "_prior", "_mean")).drop("_enc", "_prior", "_mean")
    if not noise_level:
        return j
    if id_col is None:
        raise ValueError("noise needs id_col, so that it repeats on any partitioning")
    return add_noise(j, out, id_col, noise_level, seed)


def add_noise(df: DataFrame, col: str, id_col: str, level: float = 0.01, seed: int = 0, out: str | None = None) -> DataFrame:
    """col · (1 + level · N(0,1)); the deviate depends on (seed, id) only, so it repeats on any partitioning.

    Two hashes of the id give two uniforms, Box and Muller's formula the deviate.
    """
    u = [(portable_hash(F.concat_ws(":", F.lit(f"{seed}.{i}"), F.col(id_col).cast("string"))) + 1) / F.lit(4294967297.0) for i in (1, 2)]
    z = F.sqrt(-2 * F.log(u[0])) * F.cos(u[1] * F.lit(6.283185307179586))
    return df.withColumn(out or col, F.col(col) * (1 + F.lit(level) * z))


def cross_key(df: DataFrame, cols: Sequence[str], out: str, sep: str = " ") -> DataFrame:
    """Crossed category: values joined with ``sep`` (NULL → a blank)."""
    return df.withColumn(out, F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in cols]))
