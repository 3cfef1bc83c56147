"""boxloom: building and checking visual-annotation corpora on Spark.

Every operator is a function from DataFrame to DataFrame, keyed by image.
"""
