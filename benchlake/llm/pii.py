"""PII: fixed patterns, and candidates that boosted trees select.

High-recall generators propose overlapping spans; gradient-boosted trees score each by its format
and by how much the words around it speak for personal data, which is learned from labelled sentences in
four languages.  A threshold per generator, calibrated on sentences that neither the words' weights nor the
trees have seen, selects them, and of overlapping ones the best-scored stays.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from functools import partial
from math import log
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from benchlake.llm.spans import Span, Taken, scan

KINDS = ("email", "ip", "card", "phone", "mail_text", "phone_text", "national_id", "account")
# The base patterns.
AT = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match never starts or ends inside a run of digits; saying so keeps long runs linear.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Generators, in the order of the last four kinds.
GENERATORS = (
    re.compile(r"(?<![\w.+-])[A-Za-z0-9_.+-]{2,64}\s?(?:\[at\]|\(at\)|\bat\b)\s?[A-Za-z0-9-]{2,64}\s?(?:\[dot\]|\(dot\)|\bdot\b)\s?[A-Za-z]{2,10}\b"),
    re.compile(r"(?<![\w.+-])\(?[0-9]{2,4}\)?[ ./-][0-9]{2,4}[ ./-][0-9]{3,5}(?![\w-])"),
    re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    re.compile(r"(?<!\w)(?:[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}|[0-9]{8,17})(?!\w)"),
)
NEED = ("dot", None, "-", None)  # what a text must hold for a generator to find anything
#: Labelled sentences by generator, those with personal data first; "_" is the candidate's place.
SENTENCES = (
    ("""write to _ for details | you can reach me under _ any time | send your application to _ please | my mail is _
     contact _ before friday | questions go to _ | e-mail _ | subscribe by writing to _ | her address _ is new
     schreiben Sie an _ bitte | meine Mail lautet _ | Kontakt _ | Anfragen richten Sie an _ | E-Mail _ | Bewerbungen an _
     écrivez à _ avant lundi | mon adresse est _ | courriel _ | contactez _ pour plus | envoyez votre dossier à _
     escriba a _ por favor | mi correo es _ | contacto _ | envíe su solicitud a _ | correo electrónico _""",
     """we looked _ of the map | she arrived _ of the hour | they pointed _ on the plan | the line ends _ below
     he stared _ and slept | it stopped _ again | the curve begins _ in figure two | the lamp was _ all night
     dann stand er _ im Bild | die Kurve endet _ dort | la ligne finit _ ici | il regarde _ encore
     la curva termina _ aqui | miramos _ otra vez"""),
    ("""call me at _ tomorrow | phone _ for details | my mobile is _ if needed | reach our office on _ | fax _ | text _ to confirm
     tel. _ | dial _ after six | contact number _ | telephone _ | ring _ and ask | the hotline _ is open | my cell _ is off
     call _ | please call _ today | call us on _ now | or phone us at _ | my phone _ rang | mobile _ | texting _ works too
     Telefon _ | rufen Sie uns unter _ an | Tel. _ | meine Handynummer ist _ | mobil erreichbar unter _ | Fax _ | die Telefonnummer _
     Rückruf unter _ bitte | Hotline _ | Handy _ | bitte anrufen _ | meine Nummer ist _ | téléphone _ | appelez le _ avant midi | tél. _ | mon portable est le _ | joignable au _
     numéro de fax _ | numéro de téléphone _ | teléfono _ | llame al _ por la tarde | tel. _ | mi móvil es el _ | llámenos al _
     número de fax _ | marque el _ ahora""",
     """order _ was shipped | part _ in the catalogue | version _ is out | the score was _ at last | on _ the court ruled | isbn _ second edition
     we met _ then | they counted _ units | invoice _ is due | between _ and the coast | serial _ on the back | lot _ was sold | row _ of the table
     a distance of _ was measured | Bestellung _ wurde geliefert | Ausgabe _ vom Mai | am _ beschloss der Rat | Artikel _ im Katalog
     Rechnung _ ist offen | Aktenzeichen _ liegt vor | Seite _ oben | commande _ expédiée | le _ la loi fut votée | référence _ du catalogue
     facture _ impayée | page _ en haut | article _ du code | pedido _ enviado | el _ se aprobó la ley | artículo _ del código
     factura _ pendiente | página _ arriba | referencia _ del lote"""),
    ("""my social security number is _ | ssn _ | taxpayer id _ | national id _ on file | social security _ was given | her ssn _ leaked
     identity number _ | Sozialversicherung _ | Sozialversicherungsnummer _ | meine Steuernummer ist _ | Ausweisnummer _
     numéro de sécurité sociale _ | sécurité sociale _ | numéro fiscal _ | carte d'identité _ | número de seguridad social _
     seguridad social _ | número fiscal _ | documento de identidad _""",
     """part _ in the catalogue | order _ was shipped | serial _ on the back | lot _ was sold | model _ is new | drawing _ revised
     invoice _ is due | the code _ opens page two | Bestellung _ wurde geliefert | Teil _ im Lager | Zeichnung _ geändert | Aktenzeichen _ liegt vor
     commande _ expédiée | pièce _ en stock | référence _ du catalogue | pedido _ enviado | pieza _ en almacén | referencia _ del lote"""),
    ("""account _ was opened | my account number is _ | iban _ | passport number _ | passport _ expires | bank account _ | transfer it to account _
     acct _ | driving licence _ | card number _ | pay into _ at the bank | Kontonummer _ | mein Konto _ | IBAN _ | Reisepass _ läuft ab
     Passnummer _ | überweisen Sie auf das Konto _ | Bankverbindung _ | Führerschein _ | compte _ | numéro de compte _ | passeport _ périmé
     virement sur le compte _ | iban _ | permis de conduire _ | cuenta _ | número de cuenta _ | pasaporte _ caducado
     transferencia a la cuenta _ | cuenta bancaria _ | permiso de conducir _""",
     """order _ was shipped | about _ people live there | a total of _ units | isbn _ second edition | invoice _ is due | in _ the war began
     build _ failed | part _ in the catalogue | serial _ on the back | population _ by census | timestamp _ in the log | ticket _ was closed
     some _ years ago | revenue of _ dollars | Bestellung _ wurde geliefert | rund _ Einwohner | insgesamt _ Stück | Aktenzeichen _ liegt vor
     Rechnung _ ist offen | Umsatz von _ Euro | commande _ expédiée | environ _ habitants | un total de _ pièces | facture _ impayée
     recettes de _ euros | pedido _ enviado | unos _ habitantes | un total de _ piezas | factura _ pendiente | ingresos de _ euros"""),
)
FILLER = ("the a of and to in it for on with then table report city year | der die das und in zu mit von auf für ein Bericht Stadt Jahr"
          " | le la les et de en un une pour sur avec rapport ville an | el la los y de en un una para sobre con informe ciudad año")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join([c for c in s if "0" <= c <= "9"])


def base(text: str) -> list[Span]:
    """The base spans, leftmost and non-overlapping per kind; a failing match is dropped whole."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:  # an e-mail match ends its local part at the @
        start = at
        while start > done and text[start - 1] in LOCAL_SIGNS:
            start -= 1
        m = AT.match(text, at + 1) if start < at else None
        if m:
            found.append((start, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text)
              if all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


def around(text: str, start: int, end: int) -> tuple[set[str], set[str]]:
    """The words close before and after a candidate, whole and by their first five letters."""
    before = re.findall(r"[^\W\d_]+", text[max(0, start - 60):start].lower())[-5:]
    after = re.findall(r"[^\W\d_]+", text[end:end + 40].lower())[:2]
    return tuple({t for w in side for t in (w, w[:5] + "~")} for side in (before, after))  # type: ignore[return-value]


def describe(text: str, start: int, end: int, kind: int, odds: list[dict[str, float]]) -> list[float]:
    """Format features of a candidate, and what its words' log odds sum to and reach."""
    s = text[start:end]
    digits = _digits(s)
    weights = [[odds[kind].get(w, 0.0) for w in side] or [0.0] for side in around(text, start, end)]
    last = text[max(0, start - 3):start].rstrip()[-1:]
    return [len(s), len(digits), len(digits) / len(s), sum(c in " .-/()" for c in s), len(set(digits)), float(bool(digits) and luhn(digits)),
            sum(weights[0]), max(weights[0]), min(weights[0]), sum(weights[1]), float(last in (":", "#", "=")), float(last in ("$", "€", "£")),
            float("[" in s or "(" in s), float(s[:2].isalpha() and s[:2].isupper()), float(s.startswith("0")),
            float(bool(re.match(r"(?:19|20)[0-9]{2}", digits)))]


def candidates(text: str) -> list[Span]:
    """Every generator's matches; spans of different generators may overlap."""
    out = []
    for kind, (pattern, need) in enumerate(zip(GENERATORS, NEED, strict=True)):
        if need is None or need in text:
            out += [(m.start(), kind, m.end()) for m in pattern.finditer(text)]
    return out


#: Labelled candidate: text, start, end, generator, label, number of its sentence.
Labelled = tuple[str, int, int, int, int, int]


def labelled(n: int = 2400, seed: int = 5, sentences: tuple = SENTENCES) -> list[Labelled]:
    """Labelled candidates: the sentence decides the label, whatever the candidate's format.

    Two fifths of those without personal data stand between plain words."""
    rng = random.Random(seed)
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    name = lambda: rng.choice("anna ben clara david emma felix greta hugo ines jonas".split()) + rng.choice(["", ".", "_"]) + num(rng.randint(0, 2))
    site = lambda: rng.choice("example testmail sample inbox company".split())
    plain = lambda: " ".join(rng.choice(rng.choice(FILLER.split(" | ")).split()) for _ in range(rng.randint(0, 6)))
    id_like = lambda: f"{num(3)}-{num(2)}-{num(4)}"
    phone = lambda: rng.choice([f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}-{num(3)}-{num(4)}", f"{num(3)}.{num(3)}.{num(4)}", f"0{num(3)} {num(3)} {num(4)}"])
    shapes = (
        (lambda: f"{name()}{rng.choice(['[at]', ' (at) ', ' at ', ' [at] '])}{site()}{rng.choice(['[dot]', ' dot ', '(dot)'])}{rng.choice(['com', 'org', 'de', 'fr', 'es'])}",
         lambda: f"{rng.choice(['up', 'down', 'back', 'straight', 'right'])} at {rng.choice(['the', 'one', 'some', 'every', 'that'])} dot {rng.choice(['then', 'where', 'on', 'and', 'plot'])}"),
        (phone, lambda: rng.choice([phone(), f"{num(2)}/{num(2)}/20{num(2)}0", f"{num(3)} {num(3)} {num(3)}", f"20{num(2)}-{num(2)}-{num(3)}", f"{num(2)}.{num(2)}.{num(3)}"])),
        (id_like, id_like),
        (lambda: rng.choice([f"DE{num(20)}", f"GB{num(2)}BANK{num(14)}", num(8), num(9), num(10), num(16)]), lambda: num(rng.randint(8, 17))),
    )
    parts = [[[t.strip() for t in re.split(r"[|\n]", told)] for told in pair] for pair in sentences]
    out = []
    for i in range(n):
        kind, label = i % 4, (i // 4) % 2
        place = rng.randrange(len(parts[kind][1 - label]))
        before, after = parts[kind][1 - label][place].split("_")
        if not label and rng.random() < 0.4:
            before, after = " ", " "
        before = f"{plain()} {before.rstrip()}{rng.choice([' ', ' ', ': '])}"
        s = shapes[kind][1 - label]()
        out.append((f"{before}{s}{after} {plain()}", len(before), len(before) + len(s), kind, label, place))
    return out


def word_odds(rows: list[Labelled], smoothing: float = 3.0) -> list[dict[str, float]]:
    """By generator, each word's log odds to stand by personal data."""
    out = []
    for kind in range(len(GENERATORS)):
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for t, a, b, k, y, _ in rows:
            if k == kind:
                seen[y].update(set().union(*around(t, a, b)))
        out.append({w: log((seen[1][w] + smoothing) / (seen[0][w] + smoothing)) for w in seen[0] | seen[1]})
    return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 30, rate: float = 0.3) -> list[tuple]:
    """Gradient-boosted trees of depth 2 on the logistic loss.

    A tree is (feature, cut, below, above), its sides (feature, cut, value, value)."""
    score, out = np.zeros(len(y)), []
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0.04, 0.96, 12), method="midpoint")) for f in range(x.shape[1])]

    def leaf(at, g, h):
        return float(g[at].sum() / (h[at].sum() + 1.0))

    def split(at, g, h):
        best, gain = (0, np.inf), -1.0
        for f, values in enumerate(cuts):
            for cut in values:
                low = at & (x[:, f] <= cut)
                high = at & ~low
                new = sum(g[s].sum() ** 2 / (h[s].sum() + 1.0) for s in (low, high))
                if new > gain + 1e-9:
                    best, gain = (f, float(cut)), new
        return best

    everyone = np.ones(len(y), bool)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        f, cut = split(everyone, g, h)
        sides = []
        for side in (x[:, f] <= cut, x[:, f] > cut):
            f2, cut2 = split(side, g, h)
            low = side & (x[:, f2] <= cut2)
            high = side & ~low
            values = rate * leaf(low, g, h), rate * leaf(high, g, h)
            score[low] += values[0]
            score[high] += values[1]
            sides.append((f2, cut2, *values))
        out.append((f, cut, *sides))
    return out


class Model(NamedTuple):
    """Words' log odds by generator, and the trees."""

    odds: list[dict[str, float]]
    trees: list[tuple]


def score(model: Model, text: str, start: int, end: int, kind: int) -> float:
    """The model's log odds for a candidate."""
    row, total = describe(text, start, end, kind, model.odds), 0.0
    for f, cut, below, above in model.trees:
        f2, cut2, low, high = below if row[f] <= cut else above
        total += low if row[f2] <= cut2 else high
    return total


def calibrate(scored: list[tuple[float, int, int]], precision: float = 0.97) -> list[float]:
    """By generator, the lowest log odds from which (log odds, generator, label) rows are right at the asked precision."""
    out = []
    for kind in range(len(GENERATORS)):
        right, threshold = 0, np.inf
        for n, (x, _, y) in enumerate(sorted((r for r in scored if r[1] == kind), reverse=True), 1):
            right += y
            if right >= precision * n:
                threshold = x
        out.append(float(threshold))
    return out


def train(seed: int = 5, folds: int = 4) -> tuple[Model, list[float]]:
    """The model, and thresholds from sentences that it hadn't seen.

    Sentences are dealt to folds.  A candidate is described with words' odds of the other folds, so the trees learn
    what unknown sentences look like; for the thresholds the trees, too, are those of the other folds."""
    rows = labelled(seed=seed)
    fold = np.array([r[5] % folds for r in rows])
    y = np.array([r[4] for r in rows], float)
    others = [word_odds([r for r, f in zip(rows, fold, strict=True) if f != k]) for k in range(folds)]
    x = np.array([describe(*r[:4], others[f]) for r, f in zip(rows, fold, strict=True)])
    scored = []
    for k in range(folds):
        model = Model(others[k], boost(x[fold != k], y[fold != k]))
        scored += [(score(model, *r[:4]), r[3], r[4]) for r, f in zip(rows, fold, strict=True) if f == k]
    return Model(word_odds(rows), boost(x, y)), calibrate(scored)


def select(text: str, found: list[Span], model: Model, thresholds: list[float]) -> list[Span]:
    """The candidates that the model selects: best first, none over a base span or a better one."""
    scored = sorted((-score(model, text, a, b, k), a, k, b) for a, k, b in candidates(text))
    out, taken = [], Taken(found)
    for minus, a, k, b in scored:
        span = (a, k + 4, b)
        if -minus >= thresholds[k] and taken.free(span):
            out.append(span)
            taken.take(span)
    return out


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans.

    The trees add spans of four kinds: written-out e-mail addresses, phone numbers without a plus,
    national ids and account numbers.  An added span overlaps no base span and no better one;
    ties go to the first, then to the kind listed first.

    * NULL and empty texts have no spans.  Texts are scanned whole.  A NULL doc_id stays NULL, and
      repeated rows are scanned each.
    * Only doc_id and the text are read; other columns may have any name.  Empty tables give no rows.
    """
    model, thresholds = train()
    return scan(docs, text, KINDS, 4, base, partial(select, model=model, thresholds=thresholds))
