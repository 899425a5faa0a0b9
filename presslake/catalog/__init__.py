"""Registered queries over the supplied tables."""


def load_all() -> None:
    """Import every module that registers queries."""
    from presslake.catalog import (  # noqa: F401
        article_queries,
        page_queries,
        report_queries,
        run_queries,
        stream_queries,
        tag_queries,
    )
