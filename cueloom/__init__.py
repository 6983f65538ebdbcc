"""Cueloom: time-coded, speaker-labelled transcripts as DataFrames."""
