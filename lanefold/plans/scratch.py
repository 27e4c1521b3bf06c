"""Folders for what queries write on their way."""

from lanefold.functions.shared import shared_dir as scratch  # noqa: F401
