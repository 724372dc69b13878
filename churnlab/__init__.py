"""churnlab: tabular churn analytics, preparation, training and scoring as Spark jobs."""

__version__ = "0.1.0"
