"""SQL pieces the oracles share."""

# Byte value -> token id under the base vocabulary, and a text's byte tokens.
BYTE_IDS = """list_transform(list_transform(regexp_extract_all(hex(encode({text})), '..'),
    lambda h: ('0x' || h)::INT), lambda b: CASE WHEN b >= 174 THEN b - 66 WHEN b = 173 THEN 257
    WHEN b >= 161 THEN b - 65 WHEN b >= 127 THEN b + 96 WHEN b >= 33 THEN b - 31 ELSE b + 190 END)"""


def byte_ids(text: str) -> str:
    return BYTE_IDS.format(text=text)


def turn_markup(role: str = "role", text: str = "text") -> str:
    return f"('<|' || {role} || '|>' || chr(10) || {text} || chr(10))"


def prompt_markup(text: str) -> str:
    return f"('<|user|>' || chr(10) || {text} || chr(10) || '<|assistant|>' || chr(10))"


def seeded(key: str, seed: int = 42) -> str:
    return f"md5('{seed}:' || {key})"


def fitted(ids: str, length: int, filler: int) -> str:
    return (
        f"list_concat({ids}[1:{length}], "
        f"list_transform(range(greatest({length} - len({ids}), 0)), lambda x: {filler}))"
    )
