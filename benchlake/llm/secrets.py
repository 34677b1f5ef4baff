"""Secret scans: fixed patterns, and strings that look random by two character Markov models.

One first-order model is trained from labelled random strings, the other from labelled ordinary
identifiers.  A token's mean log-likelihood ratio per character decides; the threshold of its length is
set on identifiers of words that the model hasn't seen, at a stated rate of false finds.
"""

from __future__ import annotations

import random
import re
import string

import numpy as np
from pyspark.sql import DataFrame

from benchlake.llm.spans import Span, Taken, scan

KINDS = ("assign", "access", "hex", "random")
# The base patterns.
ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Candidates of the models: whole runs of 16 characters or more.
LONG = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}(?![A-Za-z0-9+/_=-])")
#: Lengths from which a threshold of its own holds, and the share of unseen identifiers that may reach it.
BANDS, FALSE_RATE = (16, 20, 28, 40), 0.002
ALPHABET = {c: i for i, c in enumerate("^" + string.ascii_letters + string.digits + "+/_=-")}

#: Labelled ordinary identifiers.
ORDINARY = """
accessTokenValidator application_configuration_manager authentication_service_provider background-color-transition
build_release_candidate_2024 calculateTotalPriceWithTax checkout-session-handler client_connection_pool_size
com/example/library/internal/utilities content-security-policy-report-only create_user_account_request
customer_order_history_table data/processed/training/examples DatabaseConnectionFactoryBean default_timeout_milliseconds
deployment-environment-production docs/getting-started/installation-guide EmailNotificationListener
environment_variable_overrides error_message_not_found_404 example_integration_test_suite export_monthly_report_2023
feature_flag_enabled_for_everyone file_system_permission_denied generate_random_identifier getElementsByClassName
global_application_settings home/user/projects/website/static/images http_response_status_code image_processing_pipeline
InternalServerErrorException invoice_number_2022_0000154 item_description_translation java/util/concurrent/atomic
kubernetes_cluster_configuration language_preference_selector learning_rate_schedule_warmup localization-resource-bundle
maximum_number_of_connections message_queue_consumer_group migration_20240115_add_index navigation-menu-container
network_interface_controller number_of_available_processors organization_membership_invitation
package_dependency_resolution parse_configuration_file_version_2 performance_regression_benchmark
primary_key_constraint_violation quarterly_financial_statement_2021 README-contributing-guidelines
recommendation_system_evaluation registerServiceProvider release_notes_version_3_12_1 RequestMappingHandlerAdapter
resource_allocation_strategy scheduled_maintenance_window search_results_per_page_100 src/main/resources/templates
standard_deviation_estimator subscription_renewal_reminder synchronization_primitives temperature_measurement_celsius
test_should_return_empty_list_when_missing transaction_isolation_level universally_unique_identifier
unsupported_operation_exception upload_file_size_limit_10mb user_interface_component_library validate_email_address_format
versioned_documentation_website web_application_firewall_rules window_manager_configuration
zusammenarbeit_der_beteiligten_einrichtungen developpement_des_infrastructures informaciones_generales_del_proyecto
""".split()


#: Words of identifiers beside those of ORDINARY.
MORE_WORDS = """
abteilung anfrage antwort ausgabe benutzer beschreibung datei eingabe ergebnis fehler geschwindigkeit gesellschaft
haushalt kennzeichen krankenversicherung leistung mitarbeiter nachricht rechnung schnittstelle verarbeitung verwaltung
vorgang wirtschaft zeichen zugriff adresse affichage ancien chercher compteur demande dossier enregistrer entreprise
fichier gestionnaire journal langue liste modifier nouveau paiement quantite recherche requete suivant tableau traduction
utilisateur valeur archivo ayuda buscar cantidad clave consulta correo cuenta descripcion direccion ejemplo empresa
entrada fecha guardar idioma mensaje nombre pagina pedido producto respuesta siguiente usuario ventana
array batch boolean bucket buffer cache callback channel chunk column commit cursor dashboard debug decode delete encode
event export fetch filter footer format graph group hash header index input insert iterator join json label layout limit
list load lookup merge metric model mutex node object offset output parser patch payload player point policy prefix
product profile proxy query queue record region render reset retry route sample schema script select server shard sort
source stack state store stream string sync table target task test theme thread token trace tree tuple unique update url
value vector view weight worker wrapper write xml yaml zone
""".split()


def words() -> list[str]:
    """The labelled words: those of the ordinary identifiers and the further ones."""
    return sorted({w.lower() for name in ORDINARY for w in re.findall("[A-Za-z][a-z]+", name)} | set(MORE_WORDS))


def identifiers(n: int, seed: int, vocabulary: list[str]) -> list[str]:
    """Labelled ordinary strings of 16 characters or more: identifiers written from words in the usual ways,
    and one in eight a ruler, a time stamp or a number."""
    rng, out = random.Random(seed), []
    while len(out) < n:
        if rng.random() < 0.125:
            digits = lambda k: "".join(rng.choice(string.digits) for _ in range(k))
            out.append(rng.choice((
                rng.choice("-=_+/") * rng.randint(16, 80), rng.choice(("-=", "+-", "=/", "-_")) * rng.randint(8, 40),
                f"20{digits(2)}-0{digits(1)}-{digits(2)}T{digits(2)}-{digits(2)}-{digits(2)}",
                f"20{digits(2)}/1{digits(1)}/{digits(2)}/{digits(6)}", digits(rng.randint(16, 30)))))
            continue
        parts = [rng.choice(vocabulary) for _ in range(rng.randint(2, 6))]
        title = [w.capitalize() for w in parts]
        name = rng.choice(("_".join(parts), "-".join(parts), "/".join(parts), "".join(title), parts[0] + "".join(title[1:]),
                           "_".join(parts).upper(), "".join(parts[:3]), "-".join(title), "_".join(title)))
        name += rng.choice(("", "", "", f"_{rng.randint(1, 99)}", f"-{rng.randint(1990, 2030)}", f"V{rng.randint(1, 9)}", str(rng.randint(0, 999))))
        if len(name) >= BANDS[0]:
            out.append(name)
    return out


def random_strings(n: int = 600, seed: int = 11, shortest: int = 20, longest: int = 60) -> list[str]:
    """Labelled random strings: hexadecimal, letters with digits, base64 and its url form."""
    rng = random.Random(seed)
    sets = (string.hexdigits.lower()[:16], string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/",
            string.ascii_letters + string.digits + "-_", string.ascii_lowercase + string.digits)
    return ["".join(rng.choice(sets[i % len(sets)]) for _ in range(rng.randint(shortest, longest))) for i in range(n)]


def train(samples: list[str], smoothing: float = 0.2) -> np.ndarray:
    """Log transition probabilities of a first-order model; rows are the character before."""
    counts = np.full((len(ALPHABET), len(ALPHABET)), smoothing)
    for s in samples:
        path = [0, *(ALPHABET[c] for c in s)]
        np.add.at(counts, (path[:-1], path[1:]), 1)
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def ratio(token: str, table: np.ndarray) -> float:
    """Mean log-likelihood ratio of a token's characters."""
    path = np.array([0, *(ALPHABET[c] for c in token)])
    return float(table[path[:-1], path[1:]].mean())


def fit(folds: int = 4, n: int = 2000, seed: int = 3) -> tuple[np.ndarray, dict[int, float]]:
    """The table of ratios, and by length the threshold that FALSE_RATE of unseen identifiers reach.

    Each fold's identifiers are written from a part of the words and scored by models of the other words."""
    vocabulary, noise = words(), train(random_strings())
    random.Random(seed).shuffle(vocabulary)
    scored = []
    for k in range(folds):
        seen = [w for i, w in enumerate(vocabulary) if i % folds != k]
        table = noise - train(identifiers(n, seed + k, seen))
        scored += [(len(name), ratio(name, table)) for name in identifiers(n, seed + folds + k, vocabulary[k::folds])]
    limits = dict.fromkeys(BANDS, 0.0)
    for low, high in zip(BANDS, [*BANDS[1:], np.inf], strict=True):
        limits[low] = float(np.quantile([r for size, r in scored if low <= size < high], 1 - FALSE_RATE, method="higher"))
    return noise - train(ORDINARY + identifiers(n, seed + 2 * folds, vocabulary)), limits


def is_random(token: str, table: np.ndarray, limits: dict[int, float]) -> bool:
    """Whether a token of 16 characters or more reaches the threshold of its length."""
    return ratio(token, table) >= limits[max(b for b in limits if b <= len(token))]


def base(text: str) -> list[Span]:
    """The base spans.  An assignment's span is the whole match; its value has 6 characters or more."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256 and spans.

    The models add spans of kind ``random``: whole runs of 16 or more key characters that reach the threshold
    of their length and overlap no base span.

    * NULL and empty texts have no spans.  Texts are scanned whole.  A NULL doc_id stays NULL, and
      repeated rows are scanned each.
    * Only doc_id and the text are read; other columns may have any name.  Empty tables give no rows.
    """
    table, limits = fit()

    def added(t: str, found: list[Span]) -> list[Span]:
        taken = Taken(found)
        runs = [(m[0], (m.start(), 3, m.end())) for m in LONG.finditer(t)]
        return [span for token, span in runs if taken.free(span) and is_random(token, table, limits)]

    return scan(docs, text, KINDS, 3, base, added)
