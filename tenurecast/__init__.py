"""Turnover-risk scoring over wide employee-year tables, as Spark jobs."""
