"""Cell tokens as Catalyst expressions: URL-safe Base64 of three AES layouts.

``gcm``     nonce[12] | ciphertext | tag[16]
``cbc``     iv[16] | ciphertext
``fernet``  0x80 | seconds[8] | iv[16] | ciphertext | HMAC-SHA256[32]

IVs come from the cipher expression itself, one per evaluation. ``rand`` and ``uuid`` are
seeded, so a re-run task would repeat a nonce; explicit IVs exist for published vectors only.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sealframe.functions.text import called

# Fixed values of the layouts, in bytes.
METHODS = ("gcm", "cbc", "fernet")
GCM_OVERHEAD = 28
IV_BYTES = 16
AES_BLOCK = 16
FERNET_OVERHEAD = 57
FERNET_VERSION = 0x80
MAC_BYTES = 32
# The pads of PKCS, one after the other: of p bytes from 16 * (p - 1).
PADS = b"".join(bytes([p]) * AES_BLOCK for p in range(1, AES_BLOCK + 1))


def check_method(method: str, *, authenticated: bool = False) -> str:
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; choose one of {', '.join(METHODS)}")
    if authenticated and method == "cbc":
        raise ValueError("cbc has no integrity check: a changed token can decrypt to wrong text")
    return method


def check_batches_method(method: str, batches: bool) -> None:
    """``batches`` are for ``gcm``; of the others' cells, those of a row share a call already."""
    if check_method(method) != "gcm" and batches:
        raise ValueError(f"only gcm cells are sealed and opened in batches, not {method}")


def check_long_chains_method(method: str, long_chains: bool) -> None:
    if check_method(method) == "gcm" and long_chains:
        raise ValueError("gcm has a tag for each cell and no chains; its cells are sealed and opened in batches")


def seal(text: Column, key: Column, method: str, *, iv: Column | None = None,
         seconds: Column | None = None, place: Column | None = None) -> Column:
    """Token of ``text`` under the key struct of ``with_key``. A ``gcm`` token with a ``place`` opens with that place only."""
    check_method(method)
    if method == "gcm":
        return _to_token(_encrypt(text, key["whole"], "GCM", "DEFAULT", iv, place))
    if place is not None:
        raise ValueError("only gcm binds a token to its place")
    if method == "cbc":
        return _to_token(_encrypt(text, key["whole"], "CBC", "PKCS", iv))
    body = _fernet_body(_encrypt(text, key["sealing"], "CBC", "PKCS", iv), seconds)
    # The body goes into the token and into its MAC. Spark may evaluate a repeated expression
    # twice, each time with a new IV; the lambda variable is bound once.
    signed = F.transform(F.array(body), lambda b: F.concat(b, _mac(b, key)))[0]
    return F.when(text.isNotNull(), _to_token(signed))


def _fernet_body(sealed: Column, seconds: Column | None = None) -> Column:
    clock = F.unix_timestamp() if seconds is None else seconds
    return F.concat(F.lit(bytes([FERNET_VERSION])), F.unhex(F.lpad(F.hex(clock), 16, "0")), sealed)


def seal_chain(texts: list[Column], key: Column, method: str) -> Column:
    """All ``texts`` of a row sealed by one call of the cipher, for ``chain_token``; ``cbc`` and ``fernet`` only.

    Setting a cipher up costs many times what its few blocks cost. Each text, padded, comes after a block of zeros,
    whose ciphertext is the text's IV: the cipher of the block before it, which nobody can foresee (NIST SP 800-38A, appendix C).
    """
    size = [F.octet_length(t) for t in texts]
    cells = [F.concat(F.lit(bytes(AES_BLOCK)), t.cast("binary"), F.substring(F.lit(PADS), AES_BLOCK * (AES_BLOCK - 1 - n % AES_BLOCK) + 1, AES_BLOCK - n % AES_BLOCK))
             for t, n in zip(texts, size)]
    return _encrypt(_all(cells), key[_chained(method)], "CBC", "PKCS", None)


def chain_token(chain: Column, texts: list[Column], i: int, key: Column, method: str) -> Column:
    """Token of the text ``i`` of ``seal_chain``. ``chain`` must be stored or made once for each row."""
    size = [AES_BLOCK * (F.floor(F.octet_length(t) / AES_BLOCK) + 2) for t in texts]
    sealed = F.substring(chain, (IV_BYTES + 1 + _before(size, i)).cast("int"), size[i].cast("int"))
    if method == "fernet":
        sealed = called(_fernet_body(sealed), lambda b: F.concat(b, _mac(b, key)))
    return F.when(texts[i].isNotNull(), called(sealed, _to_token))


def open_chain(raws: list[Column], key: Column, method: str) -> Column:
    """The bytes of all tokens of a row opened by one call of the cipher, for ``chain_text``.

    IVs and ciphertexts one after the other are one CBC message, in which an IV opens as a block that means nothing.
    """
    return F.aes_decrypt(F.nullif(_all([_sealed(r, key, method) for r in raws]), F.lit(b"")), key[_chained(method)], F.lit("CBC"), F.lit("PKCS"))


def chain_text(chain: Column, raws: list[Column], i: int, method: str) -> Column:
    """Text of the token ``i`` of ``open_chain``; a wrong pad, or bytes that are no text, fail the query."""
    other = FERNET_OVERHEAD - IV_BYTES if method == "fernet" else 0
    size = [F.octet_length(r) - other for r in raws]
    return F.when(raws[i].isNotNull(), called(F.struct(_before(size, i).alias("at"), size[i].alias("size")), lambda place: _unpadded(chain, place["at"], place["size"])))


def _unpadded(chain: Column, at: Column, size: Column) -> Column:
    end = at + size - IV_BYTES
    pad = F.ascii(F.substring(chain, end, F.lit(1)).cast("string"))
    padded = pad.between(1, AES_BLOCK) & (F.substring(chain, end - pad + 1, pad) == F.substring(F.lit(PADS), AES_BLOCK * (pad - 1) + 1, pad))
    # The cipher itself has taken the pad of the last token.
    length = F.when(end > F.octet_length(chain), F.octet_length(chain) - at).when(padded, size - IV_BYTES - pad) \
        .otherwise(F.raise_error(F.lit("invalid token: its padding is wrong, so it is changed or of another key")).cast("int"))
    return _text(F.substring(chain, at + 1, length))


def _chained(method: str) -> str:
    if method not in ("cbc", "fernet"):
        raise ValueError("gcm has a tag for each cell, which takes a call each")
    return "whole" if method == "cbc" else "sealing"


def _all(parts: list[Column]) -> Column:
    return F.concat(*[F.coalesce(p, F.lit(b"")) for p in parts])


def _before(sizes: list[Column], i: int) -> Column:
    return sum((F.coalesce(n, F.lit(0)) for n in sizes[:i]), F.lit(0))


def _sealed(raw: Column, key: Column, method: str) -> Column:
    """IV and ciphertext of a token's bytes."""
    if method == "cbc":
        whole = (F.octet_length(raw) % AES_BLOCK == 0) & (F.octet_length(raw) >= IV_BYTES + AES_BLOCK)
        sealed, wrong = raw, "invalid token: no whole blocks"
    else:
        sealed = F.substring(raw, 10, F.length(raw) - 9 - MAC_BYTES)
        # The blocks are looked at too: a MAC of other bytes is no token.
        whole = (F.octet_length(raw) % AES_BLOCK == FERNET_OVERHEAD % AES_BLOCK) & _fernet_intact(raw, key)
        wrong = "invalid token: version or HMAC does not match"
    return F.when(raw.isNull(), F.lit(None).cast("binary")).when(whole, sealed).otherwise(F.raise_error(F.lit(wrong)).cast("binary"))


def token_bytes(token: Column) -> Column:
    """Bytes of a token; text that is no Base64 fails the query."""
    return called(token, lambda t: F.to_binary(_from_url_safe(t), F.lit("base64")))


def try_token_bytes(token: Column) -> Column:
    """Bytes of a token, none (which no method accepts) for text that is no padded Base64."""
    raw = called(token, lambda t: F.try_to_binary(_from_url_safe(t), F.lit("base64")))
    whole = F.when(F.length(token) % 4 == 0, raw)  # Spark would accept missing padding
    return F.when(token.isNotNull(), F.coalesce(whole, F.lit(b"")))


def token_text(raw: Column) -> Column:
    """Token of its bytes."""
    return called(raw, _to_token)


def opened_text(opened: Column) -> Column:
    """Text of the bytes that a token held; bytes that are no text fail the query."""
    return called(opened, _text)


def open_bytes(raw: Column, key: Column, method: str, *, place: Column | None = None) -> Column:
    """Text of a token's bytes; a wrong tag, MAC, version or place, or bytes that are no text, fail the query."""
    check_method(method)
    if method == "gcm":
        return _text(F.aes_decrypt(raw, key["whole"], F.lit("GCM"), F.lit("DEFAULT"), *([] if place is None else [place])))
    if method == "cbc":
        return _text(F.aes_decrypt(raw, key["whole"], F.lit("CBC"), F.lit("PKCS")))
    sealed = F.substring(raw, 10, F.length(raw) - 9 - MAC_BYTES)
    text = _text(F.aes_decrypt(sealed, key["sealing"], F.lit("CBC"), F.lit("PKCS")))
    return (
        F.when(raw.isNull(), F.lit(None).cast("string"))
        .when(_fernet_intact(raw, key), text)
        .otherwise(F.raise_error(F.lit("invalid token: version or HMAC does not match")))
    )


def try_open(raw: Column, key: Column, *, place: Column) -> Column:
    """Bytes of a ``gcm`` token at its place, null for one that is changed or in another place."""
    return F.try_aes_decrypt(raw, key["whole"], F.lit("GCM"), F.lit("DEFAULT"), place)


def keyed_digest(message: Column, key: Column) -> Column:
    """HMAC-SHA256 of some bytes under the first half of the key."""
    return _mac(message, key)


def keyed_digest_hex(message: Column, key: Column) -> Column:
    """The same as 64 small hexadecimal digits, which is how Spark gives it."""
    inner = F.unhex(F.sha2(F.concat(key["inner"], message), 256))
    return F.sha2(F.concat(key["outer"], inner), 256)


def _text(opened: Column) -> Column:
    return F.validate_utf8(opened.cast("string"))


def is_intact(raw: Column, key: Column, method: str) -> Column:
    """Whether a token is unchanged, from its bytes: true or false, null for null. Never fails."""
    check_method(method, authenticated=True)
    if method == "gcm":
        intact = called(raw, lambda b: F.try_aes_decrypt(b, key["whole"], F.lit("GCM")).isNotNull())
    else:
        intact = called(raw, lambda b: _fernet_intact(b, key))
    return F.when(raw.isNotNull(), intact)


def token_length(text_bytes: Column, method: str) -> Column:
    """Characters of the token of a text of ``text_bytes`` UTF-8 bytes, without sealing it."""
    check_method(method)
    blocks = AES_BLOCK * (F.floor(text_bytes / AES_BLOCK) + 1)
    raw = {
        "gcm": GCM_OVERHEAD + text_bytes,
        "cbc": IV_BYTES + blocks,
        "fernet": FERNET_OVERHEAD + blocks,
    }[method]
    return (4 * F.ceil(raw / 3)).cast("bigint")


def _encrypt(text: Column, key: Column, mode: str, padding: str, iv: Column | None, place: Column | None = None) -> Column:
    options = [F.lit(mode), F.lit(padding)] + ([] if iv is None and place is None else [F.lit(b"") if iv is None else iv]) + ([] if place is None else [place])
    return F.aes_encrypt(text, key, *options)


def _mac(message: Column, key: Column) -> Column:
    return F.unhex(keyed_digest_hex(message, key))


def _fernet_intact(raw: Column, key: Column) -> Column:
    signed = F.substring(raw, 1, F.length(raw) - MAC_BYTES)
    mac = F.substring(raw, F.length(raw) - MAC_BYTES + 1, F.lit(MAC_BYTES))
    shortest = FERNET_OVERHEAD + AES_BLOCK
    return (
        (F.length(raw) >= shortest)
        & (F.substring(raw, 1, 1) == F.lit(bytes([FERNET_VERSION])))
        & (_mac(signed, key) == mac)
    )


def _to_token(raw: Column) -> Column:
    # replace() searches bytes; translate() looks every character up and costs several times as
    # much per token. Spark's base64 also breaks lines every 76 characters.
    text = F.replace(F.base64(raw), F.lit("\r\n"), F.lit(""))
    return F.replace(F.replace(text, F.lit("+"), F.lit("-")), F.lit("/"), F.lit("_"))


def _from_url_safe(token: Column) -> Column:
    return F.replace(F.replace(token, F.lit("-"), F.lit("+")), F.lit("_"), F.lit("/"))
