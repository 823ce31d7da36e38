"""Encoders and decoders of single files in NumPy: WAV, NPY, NPZ.  Other codecs can be registered."""

from __future__ import annotations

import io
import struct
from collections.abc import Callable

import numpy as np

#: Format tags of the RIFF WAVE container.
PCM, FLOAT, EXTENSIBLE = 1, 3, 0xFFFE
MOST_CHANNELS = 128

#: Decoders by file extension: bytes -> (channels x samples, rate).
DECODERS: dict[str, Callable[[bytes], tuple[np.ndarray, int]]] = {}
#: Encoders by file extension: (channels x samples, rate) -> bytes.
ENCODERS: dict[str, Callable[[np.ndarray, int], bytes]] = {}


def register(extension: str, decode: Callable | None = None, encode: Callable | None = None) -> None:
    """Add a codec (for example MP3 or Ogg where a library for them is installed)."""
    if decode:
        DECODERS[extension] = decode
    if encode:
        ENCODERS[extension] = encode


def quantize(audio: np.ndarray, bits: int) -> np.ndarray:
    """Samples from -1 to 1 as integers, cut towards zero."""
    if bits not in (8, 16, 24, 32):
        raise ValueError(f"unsupported bit depth {bits}")
    return np.trunc(np.clip(audio, -1, 1).astype(np.float64) * (2 ** (bits - 1) - 1)).astype(np.int32)


def write_wav(audio: np.ndarray, rate: int, bits: int = 16) -> bytes:
    """A WAV file: 8, 16 or 24 bits as integers, 32 or 64 as floats."""
    audio = np.atleast_2d(np.asarray(audio))
    if bits not in (8, 16, 24, 32, 64):
        raise ValueError(f"unsupported bit depth {bits}")
    if not 1 <= len(audio) <= MOST_CHANNELS:
        raise ValueError("audio must be channels x samples")
    if bits == 8:
        data = (quantize(audio, 8) + 128).astype(np.uint8).T.tobytes()
    elif bits == 16:
        data = quantize(audio, 16).astype("<i2").T.tobytes()
    elif bits == 24:
        data = quantize(audio, 24).astype("<i4").T.copy().view(np.uint8).reshape(-1, 4)[:, :3].tobytes()
    else:
        data = audio.astype(f"<f{bits // 8}").T.tobytes()
    block = len(audio) * bits // 8
    form = struct.pack("<HHIIHH", FLOAT if bits >= 32 else PCM, len(audio), rate, rate * block, block, bits)
    pad = b"\0" * (len(data) % 2)
    body = b"WAVEfmt " + struct.pack("<I", len(form)) + form + b"data" + struct.pack("<I", len(data)) + data + pad
    return b"RIFF" + struct.pack("<I", len(body)) + body


def wav_chunks(raw: bytes, length: int | None = None) -> tuple[tuple[int, int, int, int], memoryview, int]:
    """(format, channels, rate, bits), the data chunk and its declared size.

    With ``length``, the file's size, raw may be its beginning only."""
    if len(raw) < 12 or raw[:4] != b"RIFF" or raw[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, form, data = 12, None, None
    while at + 8 <= len(raw) and data is None:
        name, size = raw[at : at + 4], struct.unpack_from("<I", raw, at + 4)[0]
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", raw, at + 8)
            if kind == EXTENSIBLE and size >= 26:
                kind = struct.unpack_from("<H", raw, at + 32)[0]
            form = kind, channels, rate, bits
        elif name == b"data":
            data = memoryview(raw)[at + 8 : at + 8 + size]
            there = len(data) if length is None else length - at - 8
        at += 8 + size + size % 2
    if form is None or data is None:
        raise ValueError("WAV file without format or data")
    if there < size:
        raise ValueError("truncated WAV file")
    return form, data, size


def read_wav(raw: bytes) -> tuple[np.ndarray, int]:
    """Samples as float32, channels x samples, and the rate."""
    (kind, channels, rate, bits), data, _ = wav_chunks(raw)
    if kind == FLOAT and bits in (32, 64):
        x = np.frombuffer(data, f"<f{bits // 8}").astype(np.float32)
    elif kind == PCM and bits == 8:
        x = (np.frombuffer(data, np.uint8).astype(np.float32) - 128) / 127
    elif kind == PCM and bits == 16:
        x = np.frombuffer(data, "<i2").astype(np.float32) / 32767
    elif kind == PCM and bits == 24:
        b = np.frombuffer(data, np.uint8).reshape(-1, 3)
        wide = np.zeros((len(b), 4), np.uint8)
        wide[:, 1:] = b
        x = ((wide.view("<i4").ravel() >> 8) / 8388607).astype(np.float32)
    else:
        raise ValueError(f"unsupported WAV format {kind} with {bits} bits")
    return x.reshape(-1, channels).T, rate


def read_wav_header(raw: bytes, length: int | None = None) -> tuple[int, int, int]:
    """(channels, samples, rate) without decoding; with ``length``, the file's size, of its beginning."""
    (_, channels, rate, bits), _, size = wav_chunks(raw, length)
    return channels, size // (channels * bits // 8), rate


def write_npy(x: np.ndarray) -> bytes:
    np.save(out := io.BytesIO(), x)
    return out.getvalue()


def read_npy(raw: bytes) -> np.ndarray:
    return np.load(io.BytesIO(raw), allow_pickle=False)


def write_npz(arrays: dict[str, np.ndarray]) -> bytes:
    np.savez(out := io.BytesIO(), **arrays)
    return out.getvalue()


def read_npz(raw: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(raw), allow_pickle=False) as found:
        return {k: found[k] for k in found.files}


def by_program(extension: str, program: str = "ffmpeg") -> bool:
    """Register a codec that pipes bytes through an installed program; false (and nothing registered) where it is absent."""
    import shutil
    import subprocess

    if shutil.which(program) is None:
        return False

    def piped(data: bytes, *arguments: str) -> bytes:
        done = subprocess.run([program, "-v", "error", "-i", "pipe:0", *arguments, "pipe:1"], input=data, capture_output=True)
        if done.returncode:
            raise ValueError(done.stderr.decode(errors="replace").strip() or f"{program} failed")
        return done.stdout

    def decode(raw: bytes) -> tuple[np.ndarray, int]:
        # an intermediate container that states its size only at the end can't be piped as WAV: take raw samples
        head = piped(raw, "-f", "au", "-c:a", "pcm_f32be")
        start, _, _, rate, channels = struct.unpack(">5I", head[4:24])
        return np.frombuffer(head[start:], ">f4").astype(np.float32).reshape(-1, channels).T, rate

    register(extension, decode, lambda x, rate: piped(write_wav(x, rate, 32), "-f", extension))
    return True


def convert(audio: np.ndarray, rate: int, target_rate: int, channels: int) -> np.ndarray:
    """Mono or stereo audio with other channels and another rate; the input stays as it is."""
    from ..operators.signal import resample

    audio = np.atleast_2d(audio)
    if audio.shape[0] not in (1, 2) or channels not in (1, 2):
        raise ValueError("only mono and stereo")
    if channels == 1:
        audio = audio.mean(0, keepdims=True)
    elif audio.shape[0] == 1:
        audio = np.repeat(audio, 2, 0)
    return resample(audio, rate, target_rate)


register("wav", read_wav, write_wav)
for _kind in ("mp3", "ogg", "webm", "flac"):
    by_program(_kind)
