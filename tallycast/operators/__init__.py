"""DataFrame-to-DataFrame operators.

Series contract: operators that order rows in time take a frame with one row
per (key, date), as ``group_reports`` and ``daily`` give. A group is then at
most one row per calendar day, however many raw rows the key had, so a window
or a packed array over one key stays small even when that key holds a third of
the raw rows.
"""
