from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from urllib.parse import quote


def partition_path(path: str, values: Mapping[str, object]) -> str:
    folders = [f"{name}={_folder_text(value)}" for name, value in values.items()]
    return "/".join([path.rstrip("/"), *folders])


def _folder_text(value: object) -> str:
    if value is None:
        return "__HIVE_DEFAULT_PARTITION__"
    text = value.strftime("%Y-%m-%d %H:%M:%S") if isinstance(value, datetime) else str(value)
    return quote(text, safe=" ")
