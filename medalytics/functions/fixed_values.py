"""Fixed values of the parliamentary open-data domain: word lists, patterns, thresholds and labels.

They must keep these values for the results to be right, and are parameters' defaults only.
"""

# fixed values: theme of a caucus title, first match wins
THEME_RULES = [
    ("agr[oí]|rural|pecuári|campo", "Agropecuária"),
    ("saúde|sa[uú]de|médic|hospital", "Saúde"),
    ("educa[çc]|escola|universidade|ensino", "Educação"),
    ("seguran[çc]|polí[cç]|defesa", "Segurança"),
    ("meio ambiente|ambiental|sustent|ecolog", "Meio Ambiente"),
    ("tecnolog|digital|inova[çc]|cyber", "Tecnologia"),
    ("mulher|gênero|feminino|matern", "Direitos da Mulher"),
    ("criança|adolescen|juvenil|infância", "Infância"),
    ("trabalh|emprego|sindic|CLT", "Trabalho"),
    ("esport|futebol|olímpic", "Esporte"),
]
THEME_DEFAULT = "Outros"

# fixed values: severity of a z-score, highest first
SEVERITY_TIERS = [(3.0, "CRITICA"), (2.5, "ALTA"), (2.0, "MEDIA")]
SEVERITY_DEFAULT = "NORMAL"

# fixed values: urgency of a voted matter by words in its text, highest first
URGENCY_WORDS = [
    (["PEC", "MEDIDA PROVISÓRIA", "MP "], "CRITICA"),
    (["PLP", "PDL", "COMPLEMENTAR"], "ALTA"),
]
URGENCY_DEFAULT = "NORMAL"
ALERT_LEVELS = ["CRITICA", "ALTA"]
PLENARY_BODY = "PLEN"

# fixed values: standard form of a vote
VOTE_RULES = [
    ("isin", ["Sim", "sim"], "SIM"),
    ("isin", ["Não", "nao", "não"], "NAO"),
    ("contains", "Abstenção", "ABSTENCAO"),
    ("contains", "Obstrução", "OBSTRUCAO"),
]

# fixed values: kind of a tax id by its digits
TAX_ID_RULES = [("rlike", r"^\d{14}$", "CNPJ"), ("rlike", r"^\d{11}$", "CPF")]
TAX_ID_DEFAULT = "OUTRO"

# fixed values: supplier flags (members served, largest document, total of a natural person)
SUPPLIER_FLAGS = {"many_members": 20, "high_value": 50_000, "id_pattern": r"^\d{11}$", "id_total": 100_000}

# fixed values: months of an election year and their labels
ELECTION_PERIODS = [((7, 10), "ELEITORAL"), ((3, 6), "PRE_ELEITORAL"), ((11, 12), "POS_ELEITORAL")]
ELECTION_DEFAULT = "REGULAR"

# fixed values: how an inquiry committee is recognised, and its status
INQUIRY_MARKS = [("tipoOrgao", "CPI"), ("sigla", "CPI"), ("nome", "Comissão Parlamentar de Inquérito")]
CLOSED_MARK, CLOSED_STATUS, OPEN_STATUS = "Encerrad", "ENCERRADA", "ATIVA"

# fixed values: closed event status, current-state marks of a bill
EVENT_CLOSED = "Encerrada"
PLENARY_STATE, ARCHIVED_STATE = "Plenário", "Arquivad"

# fixed values: weights of presence and votes in the engagement score, first day of week 1
ENGAGEMENT_WEIGHTS = (0.4, 0.6)
WEEK_BASE = "2023-01-01"

# fixed values: level of a request by HTTP status; 400 writes nothing
STATUS_LEVELS = {200: "INFO", 404: "WARN", 429: "WARN"}
STATUS_SILENT = 400
FAILED_LEVELS = ["ERROR", "CRITICAL"]
SEEN_LEVELS = ["ERROR", "CRITICAL", "WARN"]
ERROR_KINDS = {
    429: "HTTP 429 (Rate Limit)",
    400: "HTTP 400 (Bad Request)",
    404: "HTTP 404 (Not Found)",
    500: "HTTP 500 (Server Error)",
}
ERROR_DEFAULT = "Connection/Timeout Error"
CONNECTION_STEPS = [
    "API_CONNECTION_FAILED",
    "API_TIMEOUT",
    "API_TIMEOUT_EXHAUSTED",
    "API_CONNECTION_EXHAUSTED",
]
LOG_TEXT_LIMIT = 5000

# fixed values: gates and service limits
SUCCESS_GATE, ERROR_ALERT, FAILURE_LIMIT, SLA_SECONDS = 0.8, 0.05, 10, 60
FIRST_TERM_DAY = "2023-02-01"
