from storelens.sources.csv import ingest, ingest_all
from storelens.sources.jdbc import load_jdbc
from storelens.sources.parquet import overwrite, register, stamp

__all__ = ["ingest", "ingest_all", "load_jdbc", "overwrite", "register", "stamp"]
