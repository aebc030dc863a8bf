"""Model calls behind one object; the default one works offline.

A backend runs inside ``mapInPandas`` on executors. Its client repeats transient failures with a
growing wait, keeps a spacing between requests, asks once more for a well-formed reply and
records every attempt without server text or keys.
"""

from __future__ import annotations

import hashlib
import inspect
import json
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame


class FormatError(ValueError):
    """The reply is there but cannot be used."""


class RequestError(RuntimeError):
    """The request failed; ``again`` tells whether it is worth repeating."""

    def __init__(self, message: str, again: bool):
        super().__init__(message)
        self.again = again


def parse_body(raw: bytes) -> dict:
    """a JSON object, else an error that says what came instead."""
    if raw.lstrip()[:15].lower().startswith((b"<!doctype", b"<html")):
        raise RequestError("a web page came instead of JSON", False)
    try:
        body = json.loads(raw)
    except ValueError:
        raise RequestError("the body is no JSON", False) from None
    if not isinstance(body, dict):
        raise RequestError("the body is no object", False)
    return body


# Fixed values (F5): status codes, and a provider's codes of status 429, with what they mean to the caller.
MEANING = {
    401: "the key was refused",
    403: "no access to the model",
    404: "no such endpoint or model",
    408: "the request timed out",
    429: "the rate or quota is used up",
    502: "the gateway failed",
    503: "the service is not available",
    504: "the gateway timed out",
}
PROVIDER_CODES = {
    "1113": "no balance or resources are left in the account",
    "1302": "the account's request rate is at its limit",
    "1305": "the model has too many requests at the moment",
    "1308": "the present quota is used up until it is reset",
    "1309": "the subscription has ended",
    "1310": "the weekly or monthly quota is used up",
    "1311": "the subscription does not include this model",
    "1313": "the account is slowed down for fair use",
}
NO_MODEL = ("not supported", "not found", "does not exist")
ONLY_OFFICIAL = "only allows codex official clients"


def classify(status: int, body: bytes = b"") -> RequestError:
    """A safe message, never the server's own text; 408, 429 and all from 500 are worth repeating.

    The body may be a JSON error with further events behind it; what it says about a missing model
    or a provider's code is told apart.
    """
    code = said = ""
    try:
        detail, _ = json.JSONDecoder().raw_decode(body.decode("utf-8-sig", errors="replace").lstrip())
        detail = detail.get("error") if isinstance(detail, dict) else None
        if isinstance(detail, dict):
            code, said = str(detail.get("code", "")), str(detail.get("message", "")).lower()
    except ValueError:
        pass
    again = status in (408, 429) or status >= 500
    if status == 429 and code in PROVIDER_CODES:
        return RequestError(f"HTTP 429, code {code}: {PROVIDER_CODES[code]}", again)
    if ONLY_OFFICIAL in said:
        return RequestError(f"HTTP {status}: the account serves the provider's own clients only", again)
    if "model" in said and any(x in said for x in NO_MODEL):
        return RequestError(f"HTTP {status}: the configured model is not available", again)
    return RequestError(f"HTTP {status}: {MEANING.get(status, 'the request failed')}", again)


def user_reply(text: str, _: object = None) -> dict:
    """A user turn: an object of exactly a message that is not blank and a boolean."""
    value = _object(text)
    if set(value) != {"message", "goal_completed"} or not isinstance(value["message"], str) or not value["message"].strip() or type(value["goal_completed"]) is not bool:
        raise FormatError("a user turn needs message and goal_completed")
    return value


def judge_reply(text: str, principle: str) -> dict:
    """Exactly this principle with an integer score of 1, 3 or 5 and a reason that is not blank."""
    value = _object(text)
    item = value.get(principle)
    if set(value) != {principle} or not isinstance(item, dict) or set(item) != {"score", "reason"}:
        raise FormatError("only the principle with score and reason is allowed")
    if type(item["score"]) is not int or item["score"] not in (1, 3, 5) or not isinstance(item["reason"], str) or not item["reason"].strip():
        raise FormatError("the score must be the integer 1, 3 or 5, with a reason")
    return item


def plain_reply(text: str, _: object = None) -> str:
    """A character's turn: text that is not blank."""
    if not isinstance(text, str) or not text.strip():
        raise FormatError("the reply is blank")
    return text


def _object(text: str) -> dict:
    """a JSON object, also inside a fence."""
    body = text.strip()
    if body.startswith("```"):
        body = body.strip("`").removeprefix("json").strip()
    try:
        value = json.loads(body)
    except ValueError:
        raise FormatError("the reply is no JSON") from None
    if not isinstance(value, dict):
        raise FormatError("the reply is no object")
    return value


def backoff(attempt: int, longest: float = 30.0) -> float:
    """the wait before the next attempt, doubling."""
    return min(2.0**attempt, longest)


@dataclass
class Stub:
    """Offline replies that depend on the prompt alone, so that a repeated task repeats them."""

    def complete(self, role: str, messages: list[dict], validate: Callable[[str], object] | None = None) -> str:
        h = int(hashlib.sha256(json.dumps(messages, ensure_ascii=False, sort_keys=True).encode()).hexdigest()[:8], 16)
        if role == "user":
            return json.dumps({"message": f"question {h % 1000}", "goal_completed": h % 4 == 0})
        if role == "judge":
            asked = re.findall(r'\{"([^"]+)": \{"score"', messages[-1]["content"])
            return json.dumps({asked[-1] if asked else "score": {"score": 1 + 2 * (h % 3), "reason": f"case {h % 100}"}}, ensure_ascii=False)
        return f"answer {h % 1000}"


@dataclass
class ChatClient:
    """One POST per attempt to ``<base>/chat/completions``."""

    base_url: str
    model: str
    key: str = field(repr=False, default="")
    timeout: float = 90.0
    retries: int = 2
    spacing: float = 1.0
    post: Callable[[str, bytes, dict, float], bytes] | None = None
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    attempts: list[dict] = field(default_factory=list)
    _last: float = float("-inf")

    def complete(self, role: str, messages: list[dict], validate: Callable[[str], object] | None = None) -> str:
        talk, error = list(messages), None
        for n in range(self.retries + 1):
            if (wait := self.spacing - (self.clock() - self._last)) > 0:
                self.sleep(wait)
            self._last = self.clock()
            record = {"role": role, "model": self.model, "attempt": n + 1, "ok": False, "error": None, "usage": {}}
            self.attempts.append(record)
            text = None
            try:
                body = parse_body(self._send(talk))
                choice = (body.get("choices") or [None])[0]
                record["usage"] = {k: v for k, v in (body.get("usage") or {}).items() if type(v) is int}
                if not isinstance(choice, dict) or not isinstance((choice.get("message") or {}).get("content"), str):
                    raise RequestError("the reply lacks its fields", True)
                text = choice["message"]["content"]
                if choice.get("finish_reason") in ("length", "content_filter"):
                    raise FormatError("the reply is cut off or filtered")
                if validate:
                    validate(text)
                record["ok"] = True
                return text
            except (RequestError, FormatError, ValueError, OSError) as e:
                error = e
                record["error"] = type(e).__name__ if isinstance(e, OSError) else str(e)
                if isinstance(e, RequestError) and not e.again:
                    break
                if text is not None and validate:
                    talk = [*messages, {"role": "assistant", "content": text}, {"role": "user", "content": "Give only a reply of the required form."}]
                if n < self.retries:
                    self.sleep(backoff(n))
        raise error

    def _send(self, messages: list[dict]) -> bytes:
        data = json.dumps({"model": self.model, "messages": messages}).encode()
        head = {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"}
        if self.post:
            return self.post(f"{self.base_url}/chat/completions", data, head, self.timeout)
        try:
            with urllib.request.urlopen(urllib.request.Request(f"{self.base_url}/chat/completions", data, head), timeout=self.timeout) as r:
                return r.read()
        except urllib.error.HTTPError as e:
            raise classify(e.code, e.read(65536)) from None


ATTEMPTS = "array<struct<role:string,model:string,attempt:int,ok:boolean,error:string,usage:map<string,bigint>>>"


def complete_rows(
    df: DataFrame, role: str, make: Callable[[], object] = Stub, prompt: str = "messages", keep: tuple[str, ...] = ("dialogue_id",),
    check: Callable[[str, object], object] | None = None, expect: str | None = None,
    audit: Callable[[dict], None] | None = None, progress: Callable[[str, str], None] | None = None,
) -> DataFrame:
    """``(keep..., reply, error, attempts)`` for each row; ``make`` builds the backend once per task.

    ``check`` gets a reply and the row's ``expect`` column and raises if the reply is of no use:
    the backend may then ask once more, and what still fails is an error. A failed row has a null
    reply and a safe error, and does not stop the others. ``attempts`` are those of the row;
    ``audit`` is called with each of them and ``progress`` with each row's outcome, in the task.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in keep)
    wanted = [*keep, *([expect] if expect and expect not in keep else []), prompt]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backend = make()
        knows = "validate" in inspect.signature(backend.complete).parameters
        for pdf in frames:
            replies, errors, tried = [], [], []
            for m, want in zip(pdf[prompt], pdf[expect] if expect else [None] * len(pdf)):
                before = len(getattr(backend, "attempts", []))
                valid = (lambda text, want=want: check(text, want)) if check else None
                reply = error = None
                try:
                    talk = [dict(x) for x in m]
                    reply = backend.complete(role, talk, valid) if knows else backend.complete(role, talk)
                    if valid:
                        valid(reply)
                except (RequestError, FormatError, ValueError, OSError) as e:
                    reply, error = None, str(e) if isinstance(e, (RequestError, FormatError)) else type(e).__name__
                own = [dict(x) for x in getattr(backend, "attempts", [])[before:]] or [{"role": role, "model": type(backend).__name__, "attempt": 1, "ok": error is None, "error": error, "usage": {}}]
                for x in own if audit else ():
                    audit(x)
                if progress:
                    progress(role, error or "ok")
                replies.append(reply)
                errors.append(error)
                tried.append(own)
            yield pdf[list(keep)].assign(reply=replies, error=errors, attempts=tried)

    from dialoom.session import ship_package

    ship_package(df.sparkSession)
    return df.select(*wanted).mapInPandas(run, f"{fields}, reply string, error string, attempts {ATTEMPTS}")


def resolve_models(models: dict, env: dict[str, str]) -> dict[str, dict[str, str]]:
    """The endpoint of each role; a name stands for that of another role, one step deep."""
    out = {}
    for role, spec in models.items():
        target = models.get(spec) if isinstance(spec, str) else spec
        if not isinstance(target, dict):
            raise ValueError(f"{role} has no endpoint")
        missing = [target[k] for k in ("base_url_env", "model_env", "api_key_env") if not env.get(target.get(k, ""))]
        if missing:
            raise ValueError(f"{role} needs {', '.join(missing)}")
        out[role] = {"base_url": env[target["base_url_env"]], "model": env[target["model_env"]], "key": env[target["api_key_env"]]}
    return out
