"""Engagement analytics as plain DataFrame functions.

Every operator takes DataFrames and returns a DataFrame, so a whole job stays one
lazy plan until it meets a sink.
"""
