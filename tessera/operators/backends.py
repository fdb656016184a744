"""Model calls in Arrow batches: one backend for a Python worker, errors as columns."""

from __future__ import annotations

import base64
import hashlib
import json
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

import pyarrow as pa
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..config import Config

#: Rows of an Arrow batch that are Python objects at a time.
ROWS_AT_ONCE = 256
#: Characters of an error message that are kept.
ERROR_CHARS = 200


class Backend(Protocol):
    """A vision-language model."""

    def call(self, image: bytes, prompt: str) -> str: ...


class FakeBackend:
    """A deterministic stand-in: the md5 of image and prompt."""

    def __init__(self, cfg: Config):
        self.model = cfg.vlm_model

    def call(self, image: bytes, prompt: str) -> str:
        return hashlib.md5(image + prompt.encode()).hexdigest()


class MoodyBackend:
    """A stand-in that also fails, says nothing, and answers questions for YES or NO, each by the md5 of image and prompt."""

    def __init__(self, cfg: Config):
        self.model = cfg.vlm_model

    def call(self, image: bytes, prompt: str) -> str:
        d = hashlib.md5(image + prompt.encode()).hexdigest()
        if d[1] in "01":
            raise ValueError("refused")
        if "YES or NO" in prompt:
            return " yes." if d[0] in "01234" else "No, YES would be wrong"
        return " \n" if d[2] == "0" else f" {d}\n"


def data_url(image: bytes) -> str:
    """An image inside a request."""
    return "data:image/jpeg;base64," + base64.b64encode(image).decode()


def post_json(url: str, body: dict, headers: dict[str, str], timeout: int) -> dict:
    request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json", **headers})
    with urllib.request.urlopen(request, timeout=timeout) as reply:
        return json.load(reply)


class ChatBackend:
    """A server with the public chat-completions interface."""

    def __init__(self, base_url: str, model: str, key: str, timeout: int = 600, post: Callable[..., dict] = post_json):
        self.base_url, self.model, self.key, self.timeout, self.post = base_url.rstrip("/"), model, key, timeout, post

    def call(self, image: bytes, prompt: str) -> str:
        content = [{"type": "image_url", "image_url": {"url": data_url(image)}}, {"type": "text", "text": prompt}]
        body = {"model": self.model, "messages": [{"role": "user", "content": content}]}
        reply = self.post(f"{self.base_url}/chat/completions", body, {"Authorization": f"Bearer {self.key}"}, self.timeout)
        return reply["choices"][0]["message"]["content"].strip()


class GeminiBackend:
    """The public generateContent interface."""

    def __init__(self, cfg: Config, post: Callable[..., dict] = post_json):
        self.model, self.key, self.post = cfg.vlm_model, cfg.gemini_api_key, post

    def call(self, image: bytes, prompt: str) -> str:
        parts = [{"text": prompt}, {"inline_data": {"mime_type": "image/jpeg", "data": base64.b64encode(image).decode()}}]
        url = f"https://generativelanguage.googleapis.com/v1beta/models/{self.model}:generateContent"
        reply = self.post(url, {"contents": [{"parts": parts}]}, {"x-goog-api-key": self.key}, 600)
        return "".join(p.get("text", "") for p in reply["candidates"][0]["content"]["parts"]).strip()


class LocalBackend:
    """A model run in the worker by the transformers library, greedily; at most 256 new tokens."""

    def __init__(self, cfg: Config):
        from transformers import pipeline

        self.run = pipeline("image-text-to-text", model=cfg.vlm_model, device_map="auto")

    def call(self, image: bytes, prompt: str) -> str:
        content = [{"type": "image", "url": data_url(image)}, {"type": "text", "text": prompt}]
        reply = self.run(text=[{"role": "user", "content": content}], max_new_tokens=256, do_sample=False, return_full_text=False)
        return reply[0]["generated_text"].strip()


BACKENDS: dict[str, Callable[[Config], Backend]] = {
    "fake": FakeBackend,
    "moody": MoodyBackend,
    "openai": lambda cfg: ChatBackend("https://api.openai.com/v1", cfg.vlm_model, cfg.openai_api_key),
    "vllm": lambda cfg: ChatBackend(cfg.vlm_base_url, cfg.vlm_model, "none"),
    "gemini": GeminiBackend,
    "qwen_local": LocalBackend,
}


def get_backend(cfg: Config) -> Callable[[], Backend]:
    """What makes the configured backend; it is called once in each Python worker."""
    if cfg.vlm_backend not in BACKENDS:
        raise ValueError(f"unknown backend {cfg.vlm_backend!r}; known: {sorted(BACKENDS)}")
    return lambda: BACKENDS[cfg.vlm_backend](cfg)


def with_columns(rows: DataFrame, names: list[str]) -> tuple[DataFrame, StructType]:
    """rows without columns of those names, whatever their case, and the schema with text columns of those names added."""
    low = {n.lower() for n in names}
    kept = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c.lower() not in low])
    return kept, StructType([*kept.schema.fields, *(StructField(n, StringType()) for n in names)])


def message(e: Exception) -> str:
    return f"{type(e).__name__}: {e}"[:ERROR_CHARS]


def answered(rows: DataFrame, prompts: dict[str, str], make: Callable[[], Backend], image: str | None = None, at_once: int = 8, profile: ResourceProfile | None = None) -> DataFrame:
    """rows with an answer for each prompt: prompts names the columns of answers and, for each, that of its prompt.

    The calls of ROWS_AT_ONCE rows, all their prompts, run at_once at a time; a
    worker holds the objects and answers of these rows only.  A failing call gives
    a null answer and a message in `<answer>_error`, and fails nothing else; a
    null prompt is not asked.  image names a column of bytes; columns with
    the names made here are replaced.  The plan asks again where a task is
    repeated, so results are written before they are read twice.  profile asks for
    executors with accelerators.
    """
    names = [n for out in prompts for n in (out, f"{out}_error")]
    kept, schema = with_columns(rows, [n for n in names if n not in prompts.values()])
    places = {p: kept.columns.index(p) for p in prompts.values()}
    picture = kept.columns.index(image) if image else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        backend = make()

        def one(job: tuple[bytes, str | None]) -> tuple[str | None, str | None]:
            if job[1] is None:
                return None, None
            try:
                return backend.call(*job), None
            except Exception as e:  # recorded, not raised: a raise would fail the job
                return None, message(e)

        with ThreadPoolExecutor(at_once) as pool:
            for b in (whole.slice(at, ROWS_AT_ONCE) for whole in batches for at in range(0, max(whole.num_rows, 1), ROWS_AT_ONCE)):
                images = [x or b"" for x in b.column(picture).to_pylist()] if picture is not None else [b""] * b.num_rows
                asked = {out: pool.map(one, zip(images, b.column(places[p]).to_pylist(), strict=True)) for out, p in prompts.items()}
                cols = [pa.array(c, pa.string()) for got in asked.values() for c in (list(zip(*list(got), strict=True)) or [[], []])]
                yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=schema.names)

    return kept.mapInArrow(run, schema, profile=profile)
