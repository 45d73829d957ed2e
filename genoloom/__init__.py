"""genoloom: DataFrame operators for comparative-genomics tables on Spark."""
