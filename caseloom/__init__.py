"""Line-list analytics on Spark DataFrames: cleaning, derivation, quality rules, reports."""
