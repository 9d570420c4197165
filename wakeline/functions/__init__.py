"""Column builders: geometry, grid cells, cleaning, labels, rules and texts.

Every builder takes column names or SQL expressions as text and returns one Column. A formula is thereby
one parsed expression instead of dozens of single calls, which keeps the definition of wide plans fast.
"""
