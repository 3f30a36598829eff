"""Raw inputs derived from the benchmark tables, and the queries over them."""

from leadloom.bindings import load, models, operators
from leadloom.bindings.catalog import Catalog

CATALOG = Catalog()
CATALOG.include(load.CATALOG)
CATALOG.include(operators.CATALOG)
CATALOG.include(models.CATALOG)

__all__ = ["CATALOG"]
