"""Folders and fixture helpers that several test modules use."""

import os
import re

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


def local_dir(uri: str) -> str:
    """Local path of a ``file:`` scratch URI, for writing hand-made fixture files."""
    path = re.sub(r"^file:/*", "/", uri)
    os.makedirs(path, exist_ok=True)
    return path
