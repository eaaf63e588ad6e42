"""A client of chat services, for the models of ``models``: made once a task, called from its threads."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from .models import Answer, ProtocolError, RequestError, annotator, register


def chat_client(base_url: str, model: str, api_key: str | None = None, timeout: float = 1800, stream: bool = False, system: str | None = None) -> Callable[[str], Answer]:
    """``ask`` for ``annotator`` and ``translator``: posts the prompt to ``/chat/completions``; the answer has the text and its usage.

    With ``stream`` the answer comes as events, whose pieces are put together. RequestError
    where the call fails, ProtocolError where the answer has another shape.
    """
    from urllib import request

    def ask(prompt: str) -> Answer:
        messages = [{"role": "system", "content": system}] * bool(system) + [{"role": "user", "content": prompt}]
        body = {"model": model, "messages": messages, "stream": stream} | ({"stream_options": {"include_usage": True}} if stream else {})
        headers = {"Content-Type": "application/json; charset=utf-8"} | ({"Authorization": f"Bearer {api_key}"} if api_key else {})
        try:
            with request.urlopen(request.Request(f"{base_url.rstrip('/')}/chat/completions", json.dumps(body, ensure_ascii=False).encode(), headers, method="POST"), timeout=timeout) as answer:
                parts = _events(answer) if stream else [json.loads(answer.read().decode())]
                text, usage = _joined(parts, "delta" if stream else "message")
        except OSError as e:
            raise RequestError(f"{getattr(e, 'code', '')} {getattr(e, 'reason', e)}".strip()) from e
        except (ValueError, KeyError, TypeError, AttributeError, IndexError) as e:
            raise ProtocolError(f"not a chat answer: {e}") from e
        return Answer(text, provider=base_url, model=model, **{k: usage.get(k) for k in ("prompt_tokens", "completion_tokens", "total_tokens")})

    return ask


def _events(lines: Iterable[bytes]) -> Iterable[dict]:
    for line in lines:
        data = line.decode().strip()
        if data.startswith("data:") and data[5:].strip() not in ("", "[DONE]"):
            yield json.loads(data[5:])


def _joined(parts: Iterable[dict], key: str) -> tuple[str, dict]:
    """The text of the first choice's pieces, and the last usage that a part names."""
    text, usage = [], {}
    for part in parts:
        choices = part["choices"]
        if choices:
            text.append((choices[0].get(key) or {}).get("content") or "")
        usage = part.get("usage") or usage
    return "".join(text), usage


@register("chat")
def chat(base_url: str, model: str, api_key: str | None = None, **settings):
    """The back end ``chat``: annotations by a chat service."""
    return annotator(chat_client(base_url, model, api_key, **settings))
