"""Operators of a training-data pipeline: archives, quality, near duplicates, secrets, token counts,
nearest neighbours, decontamination, token files, mixing and page text."""
