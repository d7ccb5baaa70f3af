"""Column-name normalisation (camelCase -> snake_case), plan-time only."""

from __future__ import annotations

from pyspark.sql import DataFrame


def _is_upper(ch: str) -> bool:
    return "A" <= ch <= "Z"


def _is_lower(ch: str) -> bool:
    return "a" <= ch <= "z"


def to_snake_case(name: str) -> str:
    """``channelTitle`` -> ``channel_title``, ``videoID`` -> ``video_id``,
    ``HTTPResponse`` -> ``http_response``.

    An underscore goes in front of an ASCII capital when the character before it
    is a lowercase letter or digit, or when the capital starts a lowercase run
    and has any character before it.
    """
    out = []
    for i, ch in enumerate(name):
        if _is_upper(ch) and i > 0:
            prev = name[i - 1]
            nxt = name[i + 1] if i + 1 < len(name) else ""
            after_word = _is_lower(prev) or prev.isdigit() and prev.isascii()
            starts_word = _is_lower(nxt)
            if after_word or starts_word:
                out.append("_")
        out.append(ch)
    return "".join(out).lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[to_snake_case(c) for c in df.columns])
