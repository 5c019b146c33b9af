"""The analyses: functions from forum tables to result tables."""
