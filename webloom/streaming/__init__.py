"""Structured Streaming forms of the operators that grow step by step."""

from webloom.streaming.jobs import (
    deliver_unseen,
    index_stream,
    read_document_stream,
    read_streamed_postings,
    unseen_urls,
)

__all__ = ["deliver_unseen", "index_stream", "read_document_stream", "read_streamed_postings", "unseen_urls"]
