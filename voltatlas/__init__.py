"""voltatlas: Spark jobs that follow the move to electric vehicles by region.

Every model is a plain function ``DataFrame(s), parameters -> DataFrame``;
nothing is collected inside one, so the caller decides where the rows go.
"""
