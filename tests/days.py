"""The day on which tests judge."""

import datetime as dt

TODAY = dt.date(2026, 8, 17)
