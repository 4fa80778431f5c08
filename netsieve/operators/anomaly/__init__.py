"""Unsupervised detectors over scaled feature vectors."""
