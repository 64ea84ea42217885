"""Operators for training data at scale: text repair, matching, packing and mixing."""
