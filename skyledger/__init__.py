"""Flight-delay analytics on Spark: batch and continuous answers from the same operators."""
