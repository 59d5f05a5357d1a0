"""Training-data operators: dedup, joins, tokens, packing and quality.

Every operator takes and returns DataFrames, keeps its own general interface
and reads only the columns it names (extra columns, whatever their names, are
dropped on entry). ``queries`` registers one ``opN_`` query per operator.
"""
