"""Record linkage on Spark: cleaning, blocking, pair features, scoring, decisions and evaluation as DataFrame plans."""
