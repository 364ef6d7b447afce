"""Moving-asset analytics on Spark: plans, observations, features, delay models and lookups."""
