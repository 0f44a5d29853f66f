from outcomekit.sources.customers import CUSTOMER_SCHEMA, customer_outcomes  # noqa: F401
from outcomekit.sources.files import read_csv, read_parquet, write_csv  # noqa: F401
