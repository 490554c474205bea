"""Operators of the warehouse, each a function from DataFrames to a lazy DataFrame.

staging (M1) -> dims (M2-M5), marts (M6, M7, M9), spc (M8) -> metrics (Q1-Q31),
measures (X1-X9), quality (D1-D5); profile (R1-R7) works on any raw text table;
ranking holds the distributed row index, ntile and running sums the others use.
"""
