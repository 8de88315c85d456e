"""millrace: batch and streaming data operations written on PySpark DataFrames.

Every operation takes DataFrames (or a path and a session) and returns
DataFrames.  Nothing is collected on the driver; actions happen only in the
sinks and in the streaming runners.
"""
