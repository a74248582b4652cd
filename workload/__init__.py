"""The registered queries, and the SQL each one is checked against.

Every module holds ``QUERIES`` (name -> function of session and data folder) and
``ORACLES`` (name -> SQL over the same tables).
"""
