"""Change data capture as PySpark DataFrames.

Tables, partitioned tables and views become keyed snapshot messages; a landed
row-change log becomes typed inserts, updates and tombstones; both meet at one
log position. Every operator takes and returns DataFrames.
"""
