import hashlib
import re
import zlib

import numpy as np
import pytest

from cueloom.llm.decontaminate import contained_items, contaminated, drop_contaminated, greedy_tiles
from cueloom.llm.pii import Finder, find_personal_data, iban_valid, luhn
from cueloom.llm.progressive_jpeg import UNIT, Image, decode, encode_payload, media_columns, payload_of, read_payload

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True, "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), list(PATTERNS).index(kind), kind, m.end()))
    return [(a, k, b) for a, _, k, b in sorted(out)]


def test_base_spans_equal_the_patterns():
    rng, finder = np.random.default_rng(5), Finder()
    pieces = ["@", ".", "a", "b.c", "1", "23", "255", "4111 1111 1111 1111", "4111-1111-1111-1111", "+", "+1 (555) 010-9999", " ", "-", "é", "x@y.z", "1.2.3.4", "300.1.1.1", "😀", "(", ")", "%", "token = ", "79927398713000", "0", "\n"]
    for _ in range(6000):
        text = "".join(rng.choice(pieces, rng.integers(0, 14)))
        got = [s for s in finder.spans(text) if s[1] in PATTERNS]
        assert got == base_spans(text), text


def test_pii_ibans_without_cue_and_any_case():
    finder = Finder()

    def found(text):
        return [(k, text[a:b]) for a, k, b in finder.spans(text) if k not in PATTERNS]

    gb = "GB82 WEST 1234 5698 7654 32"
    assert found(f"Pay to {gb} please") == [("iban", gb)]
    assert found(f"IBAN {gb} Please pay") == found(f"{gb} Please") == found(f"Iban: {gb} 7 times") == [("iban", gb)]
    assert found("DE89370400440532013000, now") == [("iban", "DE89370400440532013000")]
    assert found("NO93 8601 1117 947 X") == [("iban", "NO93 8601 1117 947")]
    assert found("Pay GB82 WEST 1234 5698 7654 33") == found("XGB82WEST12345698765432") == found("GB82WEST123456987654321") == []
    secret = "a1b2c3d4e5f6a7b8c9"
    for cue in ("API_KEY = ", "PASSWORD=", "Token: ", "token = "):
        assert found(cue + secret) == [("secret", secret)]
    assert found("HTTPS://Host.example/X y") == [("url", "HTTPS://Host.example/X")]
    assert found(f"\u0130 Token: {secret} \u0130 {gb}") == [("secret", secret), ("iban", gb)]


def test_pii_query_shape(docs, spark, empty):
    rows = [(1, "mail a.b@c.example.org or +1 (415) 555-2671."), (2, 'token = "1eb9c654e721b4f812088970e66a6345cee33dd6"'), (3, None), (3, ""), (None, "IBAN GB82 WEST 1234 5698 7654 32 see https://u:p@h.example/x")]
    got = {(r.doc_id, r.n_email, r.n_phone): r for r in find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1, 1, 1].spans == "email:5:22,phone:26:43"
    assert got[2, 0, 0].n_added == 1 and got[2, 0, 0].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[3, 0, 0].spans == ""
    assert "iban" in got[None, 1, 0].spans and "url" in got[None, 1, 0].spans
    assert iban_valid("GB82 WEST 1234 5698 7654 32") and not iban_valid("GB82 WEST 1234 5698 7654 33")
    assert find_personal_data(empty).count() == 0
    assert find_personal_data(docs).count() == docs.count()


def test_tiles_cover_reordered_passages():
    item = list(range(1, 31))
    doc = [99] * 5 + item[15:] + [98] * 7 + item[:15]
    assert sum(n for n, _, _ in greedy_tiles(item, doc, 5)) == 30
    assert greedy_tiles(item, doc[::-1], 5) == []
    assert sum(n for n, _, _ in greedy_tiles([1, 1, 1, 1], [1, 1, 1, 1, 1, 1], 3)) == 4
    assert sum(n for n, _, _ in greedy_tiles(item, item[:8] + [99] + item[8:16], 3)) == 16
    assert greedy_tiles([], [1], 3) == []


def test_decontamination(spark, docs, empty):
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    w = item.split()
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "short one")], "item_id long, text string")
    rows = [(1, f"x y {item} z"), (2, " ".join(w[10:] + ["q"] * 9 + w[:10]).upper()), (3, " ".join(w[:7])), (4, None), (5, ""), (6, "a short one, here"), (None, item), (7, " ".join(reversed(w)))]
    d = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, item_id string")
    got = {(r.doc_id, r.item_id) for r in contained_items(d, bench).collect()}
    assert got == {(1, 1), (2, 1), (6, 4), (None, 1)}
    assert {r.doc_id for r in contaminated(d, bench).collect()} == {1, 2, 6, None}
    kept = drop_contaminated(d, bench)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 7]
    assert contained_items(empty, bench).count() == 0
    assert drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_jpeg_round_trip_and_general_decoder(monkeypatch):
    rng = np.random.default_rng(2)
    for n in (192, 384, 1920, 19200):
        payload = rng.integers(0, 256, n, dtype=np.uint8).tobytes()
        media = encode_payload(payload)
        fast = Image(media)
        assert read_payload(fast) == payload
        if n < 2000:
            with monkeypatch.context() as m:
                m.setattr(Image, "_matrix", lambda *a: False)
                slow = Image(media)
            assert all((a["data"] == b["data"]).all() for a, b in zip(fast.components, slow.components, strict=True))
        assert decode(media).shape == (fast.height, fast.width, 3)
    for edge in (b"\xff" * 192, b"\x00" * 192, bytes(range(192))):
        assert read_payload(Image(encode_payload(edge))) == edge


def test_jpeg_stack_equals_its_images(monkeypatch):
    from cueloom.llm.progressive_jpeg import encode_payloads, features_of, geometry, read_payloads

    rng = np.random.default_rng(4)
    sizes = [7 * 192, 8 * 192, 12 * 192, 9 * 192, 12 * 192, 12 * 192]
    payloads = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in sizes[:4]] + [b"\xff" * sizes[4], b"\x00" * sizes[5]]
    assert {geometry(n) for n in sizes} == {(3, 2), (2, 2)}
    for shape in ((2, 2), (3, 2)):
        some = [p for p in payloads if geometry(len(p)) == shape]
        streams = encode_payloads(some, *shape)
        assert streams == [encode_payload(p) for p in some] and len(some) > 1
        stack, images = Image(*streams), [Image(x) for x in streams]
        assert read_payloads(stack) == some
        assert (stack.rgb() == np.concatenate([x.rgb() for x in images])).all()
        apart = [features_of([x[None] for x in image.channels()])[0] for image in images]
        assert features_of([x.reshape(len(some), stack.height, stack.width) for x in stack.channels()]) == apart
        with monkeypatch.context() as m:
            m.setattr(Image, "_matrix", lambda *a: False)
            assert read_payloads(Image(*streams)) == some
    with pytest.raises(ValueError):
        Image(encode_payload(payloads[0]), encode_payload(payloads[2]))


def test_inverse_transform_matches_the_formula():
    image = Image(encode_payload(bytes(range(192))))
    c = image.components[1]
    block = np.zeros(64)
    from cueloom.llm.progressive_jpeg import ZIGZAG

    block[ZIGZAG] = c["data"][0]
    block = block.reshape(8, 8)
    k = np.arange(8)
    scale = np.where(k == 0, np.sqrt(0.5), 1)
    basis = np.cos((2 * k[:, None] + 1) * k[None, :] * np.pi / 16) * scale / 2
    want = np.clip(np.rint(basis @ block @ basis.T) + 128, 0, 255)
    got = image.plane(c)[::2, ::2]
    assert np.abs(got - want).max() <= 1


def test_media_columns(spark, docs, texts, empty):
    got = {r.doc_id: r for r in media_columns(docs, keep_media=True, keep_tensor=True).collect()}
    for i, t in texts:
        data = (t or "").encode()
        payload = data + b" " * (-len(data) % UNIT or (0 if data else UNIT))
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(data), len(payload), hashlib.sha256(payload).hexdigest())
        assert r.tail_crc32 == zlib.crc32(payload[-16:]) and r.media_sha256 == hashlib.sha256(r.media).hexdigest() and r.media_bytes == len(r.media)
        assert len(r.tensor) == r.height * r.width * 3
    assert payload_of(None) == (b" " * 192, 0)
    assert got[105].feature == got[106].feature and media_columns(empty).count() == 0
