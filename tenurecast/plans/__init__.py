"""Fitted preparation, run housekeeping and the end-to-end job."""
