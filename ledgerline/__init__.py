"""Historized business registry on Spark: cleaning, SCD2 versions, record linkage, serving views."""
