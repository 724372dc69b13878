"""Data preparation job: drop, check, split, encode, scale, metadata, write."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.operators import prep
from churnlab.operators.columns import numeric_names, remove_columns
from churnlab.operators.prepfit import fit_in_one_scan
from churnlab.sources.tables import ROLES, Roles

METADATA_SCHEMA = (
    "feature_names array<string>, target_name string, n_train bigint, n_test bigint, "
    "categorical_encoded_columns array<string>, scaled_numeric_columns array<string>, dropped_columns array<string>"
)


@dataclass
class PrepOptions:
    test_size: float = 0.2
    seed: int = 42
    stratify: bool = True
    roles: Roles = field(default_factory=lambda: ROLES)


@dataclass
class Prepared:
    data: DataFrame
    encoder: DataFrame
    scaler: DataFrame
    feature_names: list[str]
    encoded_columns: list[str]
    scaled_columns: list[str]
    dropped_columns: list[str]
    scaler_params: dict
    options: PrepOptions
    sizes: tuple[int, int] | None = None  # rows of train and test, where the fit has counted them

    def metadata(self) -> DataFrame:
        """One-row metadata table; the counts are the fit's, or from one pass over the stored split."""
        r = self.options.roles
        if self.sizes is not None:
            counts = self.data.sparkSession.createDataFrame([self.sizes], "n_train bigint, n_test bigint")
        else:
            counts = self.data.groupBy().agg(F.count_if(F.col("split") == "train").alias("n_train"),
                                             F.count_if(F.col("split") == "test").alias("n_test"))
        arr = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
        return counts.select(arr(self.feature_names).alias("feature_names"), F.lit(r.target).alias("target_name"),
                             "n_train", "n_test", arr(self.encoded_columns).alias("categorical_encoded_columns"),
                             arr(self.scaled_columns).alias("scaled_numeric_columns"),
                             arr(self.dropped_columns).alias("dropped_columns"))


def prepare(df: DataFrame, opts: PrepOptions | None = None) -> Prepared:
    """Fit on train, apply to both parts: two scans of ``df``.

    One scan gives the cuts of the split, the encoder and the scaler
    (``fit_in_one_scan``); the output is the second. The split is a comparison
    with one stored cut per class, so no copy of the table is written in between.
    """
    opts = opts or PrepOptions()
    r = opts.roles
    kept, removed = remove_columns(df, [c for c in r.drop if c != r.id_col])
    if r.id_col in r.drop and r.id_col in df.columns:
        removed = removed + [r.id_col]
    dropped = [c for c in r.drop if c in removed]
    if r.target not in kept.columns:
        raise ValueError(f"the data has no column '{r.target}' to predict")
    target = r.target if opts.stratify else None
    features = [c for c in kept.columns if c not in (r.id_col, r.target)]
    encoded_cols = [c for c in r.categorical if c in features]
    scaled_cols = [c for c in numeric_names(kept.select(*features)) if c not in encoded_cols]
    fitted = fit_in_one_scan(kept, r.id_col, target, encoded_cols, scaled_cols, opts.test_size, opts.seed)
    split = prep.split_by_cuts(kept, r.id_col, target, fitted.cuts, opts.seed)
    params = prep.scaler_params(fitted.scaler)
    data = prep.scale_transform(prep.encode_transform(split, fitted.encoder, encoded_cols), params, scaled_cols)
    data = data.select(r.id_col, *features, r.target, "split")
    return Prepared(data, fitted.encoder, fitted.scaler, features, encoded_cols, scaled_cols, dropped, params, opts,
                    (fitted.n_train, fitted.n_test))


def load_prepared(spark, path: str, opts: PrepOptions | None = None) -> Prepared:
    """Read a stored preparation (``path``/data partitioned by split, plus encoder, scaler, metadata)."""
    from churnlab.sources.prepared import load_artifacts, read_prepared

    opts = opts or PrepOptions()
    art = load_artifacts(spark, path)
    meta = art["metadata"].first()
    data = read_prepared(spark, path.rstrip("/") + "/data", meta["target_name"])
    data = data.select(opts.roles.id_col, *meta["feature_names"], meta["target_name"], "split")
    return Prepared(data, art["encoder"], art["scaler"], list(meta["feature_names"]),
                    list(meta["categorical_encoded_columns"]), list(meta["scaled_numeric_columns"]),
                    list(meta["dropped_columns"]),
                    prep.scaler_params(art["scaler"]), opts)
