"""Readers for the landing folder and the report files in it."""
