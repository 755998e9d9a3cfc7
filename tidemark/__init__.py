"""Click-event analytics on Spark: raw, clean and metric tables as DataFrame functions."""
