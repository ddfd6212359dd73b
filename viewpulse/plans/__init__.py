"""Quality indicators: every metric is one function from a log frame to a result frame, without I/O.

``fixed`` names columns that are always grouped: a minute or window label in real time, a period label offline.
"""
