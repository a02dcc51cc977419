"""Operators over tables of files, listing requests, writes and messages."""
