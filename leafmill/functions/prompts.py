"""Configuration and conversations.

A configuration is a nested dict of the driver's. What depends on a row's text
alone is an expression: a conversation is a constant prefix of messages and a
user message with the text set in.
"""

from __future__ import annotations

import logging
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

MESSAGES = "array<struct<role:string,content:array<struct<type:string,text:string>>>>"
SLOT = "{extracted_text}"

#: Defaults of every setting that has an effect.
SETTINGS = {
    "output_save_file_name": "default",
    "output_save_path": "outputs/default/",
    "model": "rules",
    "ocr_model": "rules",
    "ocr_extraction_model": None,
    "ocr_temperature": 0.01,
    "transcription_temperature": 0.01,
    "crop": True,
    "padding": 100.0,
    "resize_factor": 1,
    "remove_area_perc": 0.01,
    "middle_margin_perc": 0.20,
    "double_pages": False,
    "max_chunk_size": 3000,
}


def update_missing(custom: dict, default: dict) -> dict:
    """``custom`` with what only ``default`` has, at any depth. A value that is there stays, null too."""
    out = dict(custom)
    for key, value in default.items():
        if key not in out:
            out[key] = value
        elif isinstance(value, dict) and isinstance(out[key], dict):
            out[key] = update_missing(out[key], value)
    return out


class Config:
    """R2: settings by key; ``get`` gives a default, ``[]`` raises KeyError."""

    def __init__(self, values: dict | None, defaults: dict | None = None):
        self.values = update_missing(values or {}, SETTINGS if defaults is None else defaults)

    def get(self, key: str, default: Any = None) -> Any:
        return self.values.get(key, default)

    def __getitem__(self, key: str) -> Any:
        return self.values[key]

    @property
    def divisions(self) -> list[str]:
        own = self.values["divisions"]
        return [own] if isinstance(own, str) else list(own)

    def described(self, values: dict | None = None, indent: str = "") -> str:
        """All settings as text."""
        lines = []
        for key, value in (self.values if values is None else values).items():
            if isinstance(value, dict):
                lines += [f"=> {key}", self.described(value, indent + "  ")]
            else:
                lines.append(f"{indent}{key}: {value}")
        return "\n".join(lines)


def unravelled(prompt: Any) -> str:
    """A dict as ``Title: value`` lines, a list as its items one after another, a string as it is."""
    if isinstance(prompt, dict):
        return "".join(f"{str(k).title()}: {v}\n" for k, v in prompt.items())
    if isinstance(prompt, (list, tuple)):
        return "".join(map(unravelled, prompt))
    return prompt


def text_part(text: str) -> dict:
    return {"type": "text", "text": text}


def message(title: str, prompt: Any, role: str = "system") -> dict:
    """One message; a user's has typed parts, an image first where the title says so."""
    body = unravelled(prompt)
    if role == "user":
        return {"role": role, "content": [*([{"type": "image", "text": None}] if "image" in title.lower() else []), text_part(body)]}
    kind = title.lower() if title else ""
    if kind == "setup":
        body = f"System Message: {body}\n"
    elif kind == "schema":
        body = f"## Schema \n {schema_text(body)}\n"
    elif kind:
        body = f"## {title.upper()} \n{body}"
    return {"role": role, "content": [text_part(body)]}


def schema_text(name: str) -> str:
    """A registered schema as JSON."""
    from pyspark.sql.types import _parse_datatype_string

    from .jsonx import get_schema

    return _parse_datatype_string(get_schema(name)).json()


def filled(template: str, text: str | None) -> str:
    """A user's prompt with the text in its slot, or behind it where there is none."""
    if text is None:
        return template
    return template.replace(SLOT, text) if SLOT in template else f"{template}\n{text}"


def conversation(config: Config, text: str | None = None) -> list[dict]:
    """R5, for one text."""
    out = [message(k, v) for k, v in (config.get("system") or {}).items()]
    return out + [message(k, filled(unravelled(v), text), "user") for k, v in (config.get("user") or {}).items()]


def _part(kind: str, text: Column | str | None) -> Column:
    body = text if isinstance(text, Column) else F.lit(text).cast("string")
    return F.struct(F.lit(kind).alias("type"), body.alias("text"))


def conversations(config: Config, text: Column) -> Column:
    """R5, for a column of texts; the system's messages are constants of the plan."""
    out = [F.struct(F.lit(m["role"]).alias("role"), F.array(*(_part(p["type"], p["text"]) for p in m["content"])).alias("content")) for m in (message(k, v) for k, v in (config.get("system") or {}).items())]
    for title, prompt in (config.get("user") or {}).items():
        template = unravelled(prompt)
        if SLOT in template:
            pieces = template.split(SLOT)
            body = F.concat(*(c for i, p in enumerate(pieces) for c in ([text] if i else []) + [F.lit(p)]))
        else:
            body = F.concat(F.lit(template + "\n"), text)
        parts = [*([_part("image", None)] if "image" in title.lower() else []), _part("text", body)]
        out.append(F.struct(F.lit("user").alias("role"), F.array(*parts).alias("content")))
    return F.array(*out).cast(MESSAGES)


def flattened(messages: Column) -> Column:
    """A conversation as one string: roles, and the text of all parts."""
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(": "), F.array_join(F.transform(m["content"], lambda p: F.coalesce(p["text"], F.concat(F.lit("<"), p["type"], F.lit(">")))), ""))), "\n")


#: How a conversation is written for a model: what goes before and after each message, where an image goes, and what asks for the answer.
CHAT = {"before": "<|{role}|>\n", "after": "\n", "image": "<|image|>", "ask": "<|assistant|>\n"}


def chat_input(messages: Column, template: dict[str, str] = CHAT) -> Column:
    """struct(prompt, images): a conversation as the prompt of a model, with a place for each image, and how many these are. Null for a null conversation."""
    before, behind = template["before"].split("{role}")
    part = lambda p: F.when(p["type"] == "image", template["image"]).otherwise(F.coalesce(p["text"], F.lit("")))
    turn = lambda m: F.concat(F.lit(before), m["role"], F.lit(behind), F.array_join(F.transform(m["content"], part), ""), F.lit(template["after"]))
    images = F.aggregate(messages, F.lit(0), lambda n, m: n + F.size(F.filter(m["content"], lambda p: p["type"] == "image")))
    return F.when(messages.isNotNull(), F.struct(F.concat(F.array_join(F.transform(messages, turn), ""), F.lit(template["ask"])).alias("prompt"), images.alias("images")))


def image_prompt(system: str = "", user: str = "") -> list[dict]:
    """Asks for the text of one image."""
    return [
        {"role": "system", "content": [text_part(system or "You transcribe printed pages letter by letter.")]},
        {"role": "user", "content": [{"type": "image", "text": None}, text_part(user or "Give all text of this image and nothing else.")]},
    ]


def text_prompt(system: str, user: str) -> list[dict]:
    """R6."""
    return [{"role": "system", "content": [text_part(system)]}, {"role": "user", "content": [text_part(user)]}]


def json_prompt(broken: str) -> list[dict]:
    """Asks for a repair."""
    return [{"role": "system", "content": [text_part(f"Repair this JSON and return only the JSON.\n\n{broken}\n")]}]


def noise_prompt(text: str, context: str = "") -> list[dict]:
    """Asks for recognition errors to be mended, with what came before as context."""
    before = f"What came before:\n{context}\n\n" if context else ""
    return text_prompt("You mend errors of text recognition. Change nothing else, and return only the text.", f"{before}Text:\n{text}")


def taxa_prompt(windows: Column) -> Column:
    """A conversation for each window, which asks for the names of species under the schema ``taxa``."""
    head = F.struct(F.lit("system").alias("role"), F.array(_part("text", f"List every species name of the text as JSON of this schema: {schema_text('taxa')}")).alias("content"))
    return F.transform(windows, lambda w: F.array(head, F.struct(F.lit("user").alias("role"), F.array(_part("text", w)).alias("content"))).cast(MESSAGES))


def get_logger(name: str) -> logging.Logger:
    """A logger with one handler, however often it is asked for."""
    log = logging.getLogger(name)
    if not log.handlers:
        handler = logging.StreamHandler()
        handler.setFormatter(logging.Formatter("%(asctime)s %(name)s %(levelname)s %(message)s"))
        log.addHandler(handler)
        log.propagate = False
    return log
