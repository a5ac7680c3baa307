"""An analytics engine on Spark for a catalog of events and places."""
