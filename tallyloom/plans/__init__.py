"""Whole jobs: dividends, industry, macro series, bars, statements, companies, coverage."""
