"""DataFrame -> DataFrame operators of the warehouse (see each module's docstring)."""
