"""Stock feeds in, reconciled inventory snapshots out, on Spark DataFrames."""
