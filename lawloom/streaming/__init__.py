"""Streams of events and records: windowed counts with late data, and registers kept up to date."""
