"""Streams need nothing of their own here.

The row-level detectors keep no state: each is a filter or a join with a small
fixed table, so the functions of ``scrubline.operators.detect`` run unchanged on a
streaming DataFrame and append their rows (query ``stream_part_defects``).
"""
