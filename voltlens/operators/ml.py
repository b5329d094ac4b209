"""MLlib-style wrappers (D-3, D-4): the zone clustering as an Estimator /
Model pair and the per-zone preprocessing as a Transformer, so they compose
with ``pyspark.ml`` pipelines."""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.sql import DataFrame


class _ZoneParams(Params):
    zoneCol = Param(Params._dummy(), "zoneCol", "zone column", TypeConverters.toString)
    numCols = Param(Params._dummy(), "numCols", "numeric feature columns", TypeConverters.toListString)
    catCols = Param(Params._dummy(), "catCols", "categorical feature columns", TypeConverters.toListString)
    k = Param(Params._dummy(), "k", "clusters per zone", TypeConverters.toInt)
    m = Param(Params._dummy(), "m", "fuzzifier", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "centre updates", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "largest centre move to stop", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the start memberships", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        from voltlens.plans.pipelines import CLUSTER_CAT, CLUSTER_NUM

        self._setDefault(zoneCol="ZONA", numCols=CLUSTER_NUM, catCols=CLUSTER_CAT, k=3, m=2.0, maxIter=150,
                         tol=1e-5, seed=42)


class ZoneFuzzyCMeans(Estimator, _ZoneParams):
    """D-4: fit one fuzzy c-means model per zone (all zones in one job per iteration)."""

    def __init__(self, init=None, **kwargs):
        super().__init__()
        self._init = init
        self._set(**kwargs)

    def _fit(self, df: DataFrame) -> "ZoneFuzzyCMeansModel":
        from voltlens.plans.pipelines import train_zones

        g = self.getOrDefault
        prep, model, _ = train_zones(df, g(self.zoneCol), g(self.numCols), g(self.catCols), K=g(self.k),
                                     m=g(self.m), max_iter=g(self.maxIter), tol=g(self.tol), init=self._init,
                                     seed=g(self.seed))
        return ZoneFuzzyCMeansModel(prep, model)


class ZoneFuzzyCMeansModel(Model):
    """Adds ``cluster_0..K-1`` and ``cluster_id``; rows of zones without a model are dropped."""

    def __init__(self, prep=None, model=None):
        super().__init__()
        self.prep = prep
        self.model = model

    def _transform(self, df: DataFrame) -> DataFrame:
        from voltlens.plans.pipelines import predict_zones

        return predict_zones(df, self.prep, self.model)


class ZonePreprocessor(Transformer):
    """D-3: the fitted per-zone imputation, scaling and ordinal encoding as a Transformer."""

    def __init__(self, prep=None, prefix: str = "f"):
        super().__init__()
        self.prep = prep
        self.prefix = prefix

    def _transform(self, df: DataFrame) -> DataFrame:
        from voltlens.operators.features import transform_zone_prep

        return transform_zone_prep(df, self.prep, self.prefix)
