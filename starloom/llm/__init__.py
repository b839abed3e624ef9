"""Operations of a training-data pipeline: archives, token counts, exact
search, packing, duplicate removal, fingerprints, sharding, subword lattices
and a quality classifier.

Every operator takes DataFrames, names the columns it reads and selects them
first, so extra columns (whatever their names) never reach its plan. Nothing
else in the library imports this subpackage.
"""
