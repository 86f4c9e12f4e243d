"""A sentence generator behind an HTTP endpoint of the common chat-completions form; one request for each call, no hidden retry."""

from __future__ import annotations

import json
import os
import urllib.error
import urllib.request
from typing import Any

from marquetry.operators.adapters import environment
from marquetry.operators.branches import StatusError


class HttpGenerator:
    """base_url may stand in the variable base_url_env, the key only in api_key_env."""

    def __init__(self, model: str, base_url: str | None = None, base_url_env: str = "MARQUETRY_BASE_URL", api_key_env: str = "MARQUETRY_API_KEY", timeout_seconds: float = 180.0, more: dict[str, Any] | None = None):
        self.model, self.base_url, self.base_url_env, self.api_key_env, self.timeout, self.more = model, base_url, base_url_env, api_key_env, timeout_seconds, more or {}

    def _url(self) -> str:
        url = self.base_url or os.environ.get(self.base_url_env)
        if not url:
            raise ValueError(f"neither base_url nor {self.base_url_env} is set")
        return url.rstrip("/") + "/chat/completions"

    def ensure_ready(self) -> None:
        environment(self.api_key_env)
        self._url()

    def generate(self, request: dict[str, Any], max_tokens: int) -> dict[str, Any]:
        body = {
            "model": self.model, "temperature": request["temperature"], "max_completion_tokens": max_tokens, "response_format": request["response_format"],
            "messages": [{"role": "system", "content": request["system_prompt"]}, {"role": "user", "content": request["parts"]}], **self.more,
        }
        asked = urllib.request.Request(self._url(), json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {environment(self.api_key_env)}"})
        try:
            with urllib.request.urlopen(asked, timeout=self.timeout) as answer:
                found = json.load(answer)
        except urllib.error.HTTPError as error:
            raise StatusError(error.code, f"status {error.code}: {error.read(500).decode(errors='replace')}") from error
        except urllib.error.URLError as error:
            raise ConnectionError(str(error.reason)) from error
        choice, usage = found["choices"][0], found.get("usage") or {}
        raw = choice["message"].get("content") or ""
        return {
            "raw": raw if isinstance(raw, str) else json.dumps(raw), "finish_reason": choice.get("finish_reason"), "model": found.get("model") or self.model, "request_id": found.get("id"),
            "input_tokens": usage.get("prompt_tokens"), "output_tokens": usage.get("completion_tokens"),
        }
