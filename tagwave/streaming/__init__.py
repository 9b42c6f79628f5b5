"""Streaming: intentionally empty.

The pipeline this package rebuilds is a full purge-and-reload batch job; it
has no watermark, window, trigger or state.  The batch transforms are plain
DataFrame -> DataFrame functions, so they can run inside a
``foreachBatch`` sink unchanged if landed files ever arrive as a stream.
"""
