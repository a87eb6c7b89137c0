"""Spark operators that turn recorded signals and labelled events into trustworthy modelling datasets."""
