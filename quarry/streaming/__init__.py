"""Incremental (Structured Streaming) forms of the batch operators."""

from quarry.streaming.word_counts import document_stream, start_top_words, word_counts

__all__ = ["document_stream", "start_top_words", "word_counts"]
