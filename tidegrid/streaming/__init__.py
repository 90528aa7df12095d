"""Structured Streaming versions of the hourly increment.

Event time must be TIMESTAMP for a watermark, so naive hours are cast on entry and cast back on exit (session zone UTC).
"""
