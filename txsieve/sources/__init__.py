"""Readers and writers: feeds, messages, history, model and run tables."""
