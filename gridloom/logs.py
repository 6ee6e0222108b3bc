"""Log lines to standard error and to the end of a file."""

from __future__ import annotations

import logging
import sys

LOG = logging.getLogger("gridloom")


def set_up(path: str | None = None) -> None:
    """Handlers as asked for now; earlier ones go."""
    handlers: list[logging.Handler] = [logging.StreamHandler(sys.stderr)]
    if path:
        handlers.append(logging.FileHandler(path, mode="a", encoding="utf-8"))
    for old in list(LOG.handlers):
        LOG.removeHandler(old)
        old.close()
    for handler in handlers:
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        LOG.addHandler(handler)
    LOG.setLevel(logging.INFO)
