import random

import pytest


@pytest.fixture(scope="session")
def odd_texts():
    """Texts of many scripts, spaces and lengths, with special strings among them."""
    r = random.Random(5)
    letters = ["a", "b", "the", "ing", "é", "ß", "ж", "中", "文", "🙂", "👩‍👩‍👧", "١", "９", "½", "'s", "'re", "don't", "_", "!", "...", "▁", "�", "x" * 9]
    gaps = ["", "", "", " ", "  ", "   " * 7, "\n", "\n\n", "\t", "\r\n", " ", " ", "\x0b", "\x1c", "\x85", "\x00", "​", "<|endoftext|>", "<s>", "<0x41>", "<unk>"]
    texts = ["".join(r.choice(letters) + r.choice(gaps) for _ in range(r.randrange(1, 60))) for _ in range(500)]
    texts += ["".join(chr(r.choice([r.randrange(32, 0xD7FF), r.randrange(0xE000, 0x10FFFF)])) for _ in range(30)) for _ in range(200)]
    return [*texts, "", " ", "\n", "a" * 5000, " " * 5000, "ab" * 4000, "<|endoftext|>" * 3, "  lead", "trail  "]
