"""Plans over the driver's tables: the postings frame and the registered queries."""


def load() -> None:
    """Registers the queries of all modules."""
    from vacantia.plans import case_queries, column_queries, feed_queries, filter_queries, join_queries, metric_queries, stream_queries  # noqa: F401
