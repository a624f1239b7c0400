"""Readers, writers and generated calendars."""
