"""Streaming.

The reference has no streaming, windowing or late-data logic.  The one thing
a stream can use here is scoring: assignment against fixed centroids is a
map-only expression, so :func:`centrix.streaming.score.score_stream` applies
it unchanged to a ``readStream`` DataFrame.
"""
