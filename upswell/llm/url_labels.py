"""A small labelled table of URLs for the URL filter, made from word lists by a rule. Hosts are under the reserved name `example`."""

from __future__ import annotations

from collections.abc import Iterator

BLOCK_WORDS = (
    "casino poker jackpot slots roulette bets betting bookmaker lottery scratchcard pills viagra meds pharmacy steroids replica counterfeit adult xxx sex cams "
    "singles ads adserver track tracker click popup pixel banner spam linkfarm doorway warez crack keygen serials torrent payday loans bonus freemoney winbig cheap"
).split()
ALLOW_WORDS = (
    "library museum herald weather garden mountain university press train river maps council kitchen chemistry school gallery harbour chess music theatre "
    "science history recipes forum wiki journal gazette observatory bakery cycling birds poetry parish hospital dentist architect software docs archive news sailing"
).split()
#: On both sides, so that they tell nothing.
NEUTRAL = "city best online my daily world new top hub central north open".split()
SYLLABLES = "ta re mo lin ven sor kal dri pos ne fer ul bra zim tho quen".split()
FRONT = ["", "www.", "m.", "blog.", "shop."]
LANGUAGES = ["en", "de", "fr", "es"]
PER_WORD = 6


def _paths(i: int) -> str:
    n, lang = 13 + i * 37 % 9000, LANGUAGES[i % 4]
    return ["/", f"/{lang}/{n}", f"/{lang}/{n}.html", f"/{lang}/{n}/", f"/a/{n}?page={i % 5}", f"/{lang}/#top"][i % 6]


def _urls(words: list[str]) -> Iterator[str]:
    for k, word in enumerate(words):
        for j in range(PER_WORD):
            i = PER_WORD * k + j
            other, near = NEUTRAL[i * 5 % len(NEUTRAL)], words[(k + 7 * j + 1) % len(words)]
            name = [f"{word}-{other}", f"{other}-{word}", f"{word}{other}", word, f"{word}-{near}", f"{other}{word}"][j]
            yield f"{'https' if i % 3 else 'http'}://{FRONT[i * 7 % 5]}{name}.example{_paths(i * 11 // 3)}"


def _invented(n: int) -> Iterator[str]:
    """Names without a meaning: what is not known is let through."""
    for i in range(n):
        name = "".join(SYLLABLES[(i * p + q) % len(SYLLABLES)] for p, q in ((3, 1), (5, i // 16), (7, i // 5))[: 2 + i % 2])
        yield f"https://{FRONT[i % 5]}{name}.example{_paths(i)}"


LABELLED = tuple((u, "block") for u in _urls(BLOCK_WORDS)) + tuple((u, "allow") for u in (*_urls(ALLOW_WORDS), *_invented(240)))
