from tidemark.sinks.catalog import CatalogStore
from tidemark.sinks.versioned import ConcurrentPublish, MissingTable, VersionedStore

__all__ = ["CatalogStore", "ConcurrentPublish", "MissingTable", "VersionedStore"]
