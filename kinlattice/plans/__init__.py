"""Query catalogues: a callable and, where SQL can say it, the SQL twin."""
