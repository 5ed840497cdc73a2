import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from facetry.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        "tests",
        "8",
        **{
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def texts():
    """Seeded texts over Han, Latin, digits, symbols, emoji, blanks and the class borders."""
    import random

    rng = random.Random(16)
    alphabet = list("好吃面店的了，。！abcXYZ019 \t\n\r-+~'\"\\[]") + [
        "一", "鿿", "　", " ", "﻿", "\x0b", "\x1c", "\x85", "…", "【", "】",
        "：", "；", "￥", "😀", "👍", "🏽", "‍", "❤", "️", "é", "ß", "İ", "Σ", "\U0002070e",
    ]
    made = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(300)]
    return ["", "的", " \n", "\t", "　", *made]
