"""The registered queries and, for each, the SQL another engine runs to check it."""
