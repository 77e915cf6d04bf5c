"""Readers of landed captures and API bodies, and idempotent writers."""
