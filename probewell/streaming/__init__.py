"""No job of this package is a stream: its inputs are closed files, and nothing in its domain has event times or late data.

The operators are plain DataFrame functions; those without sorts and windows (filters, flags, CIGAR and sequence columns)
also run on a streaming DataFrame as they are.
"""
