"""The named OLAP reports over the test mart, each with its check query."""

from checks.reports import hierarchies, highlights, trends

REPORTS = {**hierarchies.REPORTS, **trends.REPORTS, **highlights.REPORTS}
