"""Audio-event tables on Spark: every operator takes and returns DataFrames."""
