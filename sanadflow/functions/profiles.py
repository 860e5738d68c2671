"""How a text is normalised, cut into words and recognised: one :class:`Profile` for each tradition of text."""

from __future__ import annotations

from dataclasses import dataclass

# Marks that carry no letter; folds of the two Arabic profiles; stop words, attribution markers and chain cues.
MARKS = "ً-ْـٰٓ-ٕ"
CORPUS_FOLDS = (("إأآ", "ا"), ("ى", "ي"), ("ة", "ه"), ("ؤ", "و"), ("ئ", "ي"))
VERDICT_FOLDS = (("إأآ", "ا"), ("ى", "ي"), ("ة", "ه"), ("ؤئ", "و"))
CORPUS_STOP = (
    "حدثنا حدثني اخبرنا اخبرني انبانا قال قالت قالوا عن بن ابن ابي ابو ثنا نا سمعت رضي الله عنه عنها عنهم وسلم عليه صلى رسول النبي ان اني انه وقال وعن "
    "يا ما لا من في على الي هذا هذه ذلك كان كانت وهو وهي ثم قد لقد وقد به له بها لها اليه فيه منه انا نحن هم هو هي التي الذي"
)
VERDICT_STOP = (
    "حدثنا حدثني اخبرنا اخبرني انبانا قال قالت قالوا عن بن ابن ابي ابو ثنا نا سمعت رضي الله عنه عنها عنهم وسلم عليه صلي رسول النبي ان اني انه وقال وعن "
    "يا ما لا من في علي الي هذا هذه ذلك كان كانت وهو وهي ثم قد وقد به له"
)
MARKERS = ("صلي الله عليه وسلم", "رسول الله", "النبي", "نبي الله")
CUES = ("حدثنا", "حدثني", "اخبرنا", "اخبرني", "انبانا", "سمعت", "ثنا", "عن")


@dataclass(frozen=True)
class Profile:
    """``folds``: letters and what they become. ``words``: what a word is made of, as the inside
    of a character class. ``shortest``: letters of the shortest word. ``markers`` and ``cues``:
    a text is attributed if it holds one of each. ``blessing``: a phrase dropped before words
    are cut; None keeps it."""

    name: str
    words: str
    folds: tuple[tuple[str, str], ...] = ()
    marks: str = MARKS
    lower: bool = False
    compatibility: bool = False
    stop: frozenset[str] = frozenset()
    shortest: int = 3
    markers: tuple[str, ...] = ()
    cues: tuple[str, ...] = ()
    blessing: str | None = None

    @property
    def pairs(self) -> tuple[str, str]:
        """The folds as two strings of one length."""
        return "".join(a for a, _ in self.folds), "".join(b * len(a) for a, b in self.folds)

    def with_normal_stop_words(self) -> Profile:
        """The same with stop words folded like the words they are compared with."""
        table = str.maketrans(*self.pairs)
        return Profile(**{**self.__dict__, "stop": frozenset(x.translate(table) for x in self.stop)})


CORPUS = Profile("corpus", "ء-ي", CORPUS_FOLDS, stop=frozenset(CORPUS_STOP.split()), markers=MARKERS, cues=CUES)
VERDICT = Profile("verdict", "ء-ي", VERDICT_FOLDS, compatibility=True, stop=frozenset(VERDICT_STOP.split()))
LATIN = Profile("latin", r"\p{L}", marks="", lower=True)
