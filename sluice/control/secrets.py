"""Where a source's credentials come from: a JSON file a secret id, or the credential providers of the session's Hadoop client."""

from __future__ import annotations

import json
from collections.abc import Callable

from sluice.control.errors import ConfigurationError


def _parsed(secret_id: str, text: str) -> dict:
    try:
        data = json.loads(text)
    except ValueError:
        data = None
    if not isinstance(data, dict):
        raise ConfigurationError(f"the secret {secret_id} isn't a JSON object")
    return data


def from_folder(files, folder: str) -> Callable[[str | None], dict]:
    """Reads ``<folder>/<secret id>.json``. A source without secret id has no credentials; nothing is fetched for it."""

    def fetch(secret_id: str | None) -> dict:
        if secret_id is None:
            return {}
        if "/" in secret_id or secret_id.startswith("."):
            raise ConfigurationError(f"unusable secret id {secret_id!r}")
        text = files.read(f"{folder.rstrip('/')}/{secret_id}.json")
        if text is None:
            raise ConfigurationError(f"no secret {secret_id}")
        return _parsed(secret_id, text)

    return fetch


def from_session(spark) -> Callable[[str | None], dict]:
    """Asks the providers named in ``hadoop.security.credential.provider.path`` for the secret id; the value is a JSON object. A secret
    that no provider has gives no credentials, as catalog tables and Parquet folders need none."""

    def fetch(secret_id: str | None) -> dict:
        value = spark._jsc.hadoopConfiguration().getPassword(secret_id) if secret_id else None
        return {} if value is None else _parsed(secret_id, "".join(value))

    return fetch
