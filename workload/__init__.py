"""The registered queries, each with the SQL that states its result.

Every module has QUERIES (name to function of session and table folder) and
ORACLE (name to SQL over the same tables).
"""
