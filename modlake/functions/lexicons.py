"""Word lists behind the text features.

Every list in this module is a fixed value: a feature count is only right when
the list is exactly this one.  Callers who want other words pass their own
``Lexicons`` object; the patterns and lookups are generated from it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: plain profanity ------------------------------------------
PROFANITY = (
    "ass", "asshole", "bastard", "bitch", "bullshit", "crap", "cunt", "damn",
    "dick", "dumbass", "fuck", "fucker", "fucking", "idiot", "jackass",
    "loser", "moron", "retard", "shit", "slut", "stupid", "trash", "whore",
)

# --- fixed values: toxic slang ----------------------------------------------
SLANG = (
    "kys", "kms", "stfu", "gtfo", "gtfoh", "foh", "gfys", "gfy", "stfd",
    "gth", "rekt", "pwned", "noob", "diaf", "esad", "foad", "wtf", "ffs",
    "omfg", "jfc", "tf", "smfh", "smmfh", "fml", "mf", "mofo", "bs", "fu",
    "fy", "pos", "sob", "thot", "incel", "simp", "cuck", "libtard", "retard",
    "tard", "snowflake", "feminazi", "sjw", "npc", "idgaf", "dgaf", "rtfm",
    "cope", "seethe", "smd", "dilate", "lmao", "lmfao", "smh", "af", "kek",
)

# --- fixed values: negation words (ASCII apostrophe only) -------------------
NEGATION = (
    "not", "never", "no", "nobody", "nothing", "neither", "nowhere", "nor",
    "cannot", "can't", "won't", "wouldn't", "shouldn't", "couldn't", "didn't",
    "doesn't", "don't", "isn't", "aren't", "wasn't", "weren't", "hadn't",
    "hasn't", "haven't", "needn't", "mustn't",
)

# --- fixed values: second-person forms, in matching order -------------------
SECOND_PERSON = (
    "you", "your", "yours", "yourself", "yourselves", "you're", "you'll",
    "you've", "you'd", "ur", "u",
)

# --- fixed values: letters that stand in for others -------------------------
LEET_FROM = "@$501!37+"
LEET_TO = "assoiiett"

# --- fixed values: identity terms, in matching order ------------------------
IDENTITY_RACE = (
    "black", "african", "african american", "afro-american", "negro",
    "colored", "white", "caucasian", "european", "asian", "east asian",
    "southeast asian", "south asian", "chinese", "japanese", "korean",
    "vietnamese", "filipino", "thai", "indonesian", "malaysian",
    "singaporean", "indian", "pakistani", "bangladeshi", "sri lankan",
    "nepalese", "hispanic", "latino", "latina", "latinx", "chicano",
    "chicana", "mestizo", "mexican", "puerto rican", "cuban", "dominican",
    "salvadoran", "guatemalan", "colombian", "venezuelan", "peruvian",
    "argentinian", "brazilian", "bolivian", "ecuadorian", "arab", "arabic",
    "middle eastern", "persian", "iranian", "turkish", "kurdish", "armenian",
    "lebanese", "syrian", "egyptian", "moroccan", "algerian", "libyan",
    "tunisian", "jewish", "jew", "slavic", "russian", "ukrainian", "polish",
    "romanian", "hungarian", "czech", "slovak", "serbian", "croatian",
    "indigenous", "native american", "american indian", "first nations",
    "aboriginal", "pacific islander", "hawaiian", "samoan", "tongan",
    "fijian", "maori", "romani", "gypsy", "biracial", "multiracial",
    "mixed race",
)
IDENTITY_GENDER = (
    "woman", "women", "female", "girl", "lady", "ladies", "femme", "man",
    "men", "male", "boy", "transgender", "trans", "transwoman", "transman",
    "trans woman", "trans man", "transsexual", "nonbinary", "non-binary",
    "genderqueer", "gender queer", "genderfluid", "gender fluid",
    "gender nonconforming", "agender", "bigender", "enby", "intersex",
    "cisgender", "cis", "butch",
)
IDENTITY_SEXUALITY = (
    "gay", "lesbian", "bisexual", "bi", "pansexual", "pan", "asexual", "ace",
    "queer", "homosexual", "heterosexual", "straight", "demisexual",
    "aromantic", "lgbt", "lgbtq", "lgbtqia", "lgbtq+", "same-sex",
    "same sex", "sodomite",
)
IDENTITY_RELIGION = (
    "christian", "christianity", "catholic", "catholicism", "protestant",
    "evangelical", "baptist", "lutheran", "methodist", "presbyterian",
    "anglican", "episcopal", "orthodox", "mormon", "latter-day saint",
    "jehovah", "muslim", "islam", "islamic", "sunni", "shia", "shiite",
    "islamist", "jewish", "judaism", "hasidic", "zionist", "antisemit",
    "hindu", "hinduism", "buddhist", "buddhism", "sikh", "sikhism", "atheist",
    "atheism", "agnostic", "agnosticism", "secular", "irreligious", "pagan",
    "wiccan", "wicca", "scientologist", "scientology", "satanist",
)
IDENTITY_DISABILITY = (
    "disabled", "disability", "handicapped", "autistic", "autism",
    "autism spectrum", "asperger", "adhd", "attention deficit", "dyslexic",
    "dyslexia", "bipolar", "schizophrenic", "schizophrenia", "mentally ill",
    "mental illness", "mental health", "psychotic", "paranoid", "blind",
    "visually impaired", "deaf", "hard of hearing", "wheelchair",
    "wheelchair user", "amputee", "paraplegic", "quadriplegic",
    "cerebral palsy", "down syndrome", "downs syndrome", "alzheimer",
    "dementia", "epileptic", "epilepsy", "chronic illness", "chronic pain",
)
IDENTITY_NATIONALITY = (
    "immigrant", "immigrants", "migrant", "migrants", "migration", "refugee",
    "refugees", "asylum seeker", "asylum seekers", "undocumented",
    "illegal immigrant", "illegal immigrants", "illegal alien", "foreigner",
    "foreigners", "deported", "american", "british", "french", "german",
    "irish", "italian", "greek", "spanish",
)


def _identity_default() -> dict[str, tuple[str, ...]]:
    return {
        "race": IDENTITY_RACE,
        "gender": IDENTITY_GENDER,
        "sexuality": IDENTITY_SEXUALITY,
        "religion": IDENTITY_RELIGION,
        "disability": IDENTITY_DISABILITY,
        "nationality": IDENTITY_NATIONALITY,
    }


@dataclass(frozen=True)
class Lexicons:
    """The word lists one feature run uses."""

    profanity: tuple[str, ...] = PROFANITY
    slang: tuple[str, ...] = SLANG
    negation: tuple[str, ...] = NEGATION
    second_person: tuple[str, ...] = SECOND_PERSON
    identity: dict[str, tuple[str, ...]] = field(default_factory=_identity_default)

    def identity_terms(self) -> list[str]:
        """All identity terms, category after category."""
        return [t for terms in self.identity.values() for t in terms]


DEFAULT = Lexicons()
