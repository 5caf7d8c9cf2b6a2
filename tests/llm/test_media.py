import hashlib
import math
import wave
import io
import zlib

import numpy as np

from quillspark.llm import media

from .helpers import ODD, documents, prose


def test_payload_round_trip(spark):
    texts = ODD + [prose(1, 300), prose(1, 300)]
    rows = {r["doc_id"]: r for r in media.with_fingerprints(media.with_media(documents(spark, texts))).collect()}
    stored = {r["doc_id"]: bytes(r["media"]) for r in media.with_media(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        data = (t or "").encode()
        payload = data + b" " * (-len(data) % 192 or (192 if not data else 0))
        with wave.open(io.BytesIO(stored[i])) as f:
            assert (f.getsampwidth(), f.getnchannels(), f.readframes(f.getnframes())) == (1, 1, payload)
        r = rows[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(stored[i]), hashlib.sha256(stored[i]).hexdigest())
        assert len(r["times"]) == len(r["hashes"]) and list(r["times"]) == sorted(r["times"])
    a, b = rows[len(texts) - 2], rows[len(texts) - 1]
    assert tuple(a)[1:] == tuple(b)[1:] and a["times"]
    assert media.with_fingerprints(media.with_media(documents(spark, ODD).limit(0))).count() == 0


def test_a_tone_is_found_and_blocks_agree(monkeypatch):
    t = np.arange(192 * 60)
    tone = (128 + 100 * np.sin(2 * np.pi * t * 20 / 192) * (t % 3000 > 1500)).astype(np.uint8)
    frames, bins = media.peaks(tone)
    assert (bins == 20).sum() > 5
    whole = media.fingerprints(tone)
    monkeypatch.setattr(media, "FRAMES", 16)
    again = media.fingerprints(tone)
    assert (whole[0] == again[0]).all() and (whole[1] == again[1]).all()


def test_a_cut_out_keeps_its_pairs():
    rnd = np.random.default_rng(2)
    sound = rnd.integers(0, 256, 192 * 80).astype(np.uint8)
    t, h = media.fingerprints(sound)
    t2, h2 = media.fingerprints(sound[96 * 40 :])
    both = set(zip(t.tolist(), h.tolist())) & {(a + 40, b) for a, b in zip(t2.tolist(), h2.tolist())}
    assert len(both) > 0.5 * len(t2)


def plain_pairs(payload):
    """The fingerprint's rule by sums of sines and cosines in double precision, frame by frame."""
    x = [b - 128.0 for b in payload] + [0.0] * (media.UNIT // 2)
    turn = 2 * math.pi / media.UNIT
    window = [0.5 - 0.5 * math.cos(turn * i) for i in range(media.UNIT)]
    tops, bins = [], []
    for start in range(0, len(x) - media.UNIT + 1, media.UNIT // 2):
        frame = [a * w for a, w in zip(x[start : start + media.UNIT], window)]
        power = [math.hypot(sum(v * math.cos(turn * k * i) for i, v in enumerate(frame)), sum(v * math.sin(turn * k * i) for i, v in enumerate(frame))) for k in range(media.UNIT // 2 + 1)]
        best = [max(range(a, b), key=lambda k: power[k]) for a, b in media.BANDS]
        bins.append(best)
        tops.append([power[k] for k in best])
    mean = [sum(t[j] for t in tops) / len(tops) for j in range(len(media.BANDS))]
    peaks = [(f, bins[f][j]) for f, t in enumerate(tops) for j in range(len(media.BANDS)) if t[j] > mean[j] and t[j] >= max(o[j] for o in tops[max(0, f - media.NEAR) : f + media.NEAR + 1])]
    pairs = [(f, (a << 14) | (b << 7) | (g - f)) for i, (f, a) in enumerate(peaks) for g, b in peaks[i + 1 : i + 1 + media.FAN] if g - f <= media.REACH]
    return sorted(pairs)


def test_fingerprints_of_texts_against_a_plain_transform(spark):
    texts = [prose(seed, 60 + 40 * seed) for seed in range(4)] + ["日本語 テキスト " * 30 + prose(9, 50)]
    rows = {r["doc_id"]: r for r in media.with_fingerprints(media.with_media(documents(spark, texts))).collect()}
    for i, t in enumerate(texts):
        data = t.encode()
        want = plain_pairs(data + b" " * (-len(data) % media.UNIT))
        assert want and list(zip(rows[i]["times"], rows[i]["hashes"])) == want
