"""Inputs: files, transaction lines, streams, replayed samples."""
