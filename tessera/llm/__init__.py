"""Operators for preparing training text at scale; nothing else in the
library imports this subpackage.  Their registered queries are in
``queries.py``, the SQL they are checked against in ``sql.py``."""
