"""Word lists, patterns, limits and tables whose content decides results.

Patterns are written without flags; the functions that use them add the Java
flags they need (Unicode classes, case folding, line ends).
"""

# --- Article headings -------------------------------------------------------
# Tied to a line start, any case; `º` may follow the number but does not end the heading.
ARTICLE_HEADING = r"(?:^|\n)\s*(?:Artículo|Art\.|Art)\s+(\d+(?:[\-º°]?[A-Za-z0-9]*)?)\s*[\.\-\°)]"
# Anywhere in the text, case kept; `º` ends the heading.
CODE_ARTICLE_HEADING = r"Art[ií]culo\s+(\d+[A-Za-z\-]*)\s*[\.\-º°]"

# --- Citations --------------------------------------------------------------
CITATION_PATTERNS = [
    (r"(?:Ley|Ley N[°º])\s+(\d+)", "Ley"),
    (r"(?:Decreto Legislativo|D\.L\.|DL)\s*[Nn]?[°º]?\s*(\d+)", "Decreto Legislativo"),
    (r"(?:Decreto de Urgencia|D\.U\.|DU)\s*[Nn]?[°º]?\s*(\d+[-\d]*)", "Decreto de Urgencia"),
    (r"(?:Decreto Supremo|D\.S\.|DS)\s*[Nn]?[°º]?\s*(\d+[-\d]+-[A-Z]+)", "Decreto Supremo"),
    (r"(?:Resolución Ministerial|R\.M\.|RM)\s*[Nn]?[°º]?\s*(\d+[-\d]+-[A-Z]+)", "Resolución Ministerial"),
    (r"(?:Código Penal)", "Código"),
    (r"(?:Código Civil)", "Código"),
    (r"(?:Constitución Política)", "Constitución"),
]
#: Lower-case words of which a text must hold one for the pattern of the same place to match.
CITATION_NEEDS = [
    ("ley",), ("decreto legislativo", "d.l.", "dl"), ("decreto de urgencia", "d.u.", "du"), ("decreto supremo", "d.s.", "ds"),
    ("resolución ministerial", "r.m.", "rm"), ("código penal",), ("código civil",), ("constitución política",),
]
CITATION_CONTEXT_CHARS = 50
CITATION_CUES = [
    ("repeals", ["deroga", "derógase", "déjase sin efecto", "sustituye"]),
    ("modifies", ["modifica", "modifíquese", "incorpóra"]),
    ("repealed_by", ["derogada por", "sustituida por"]),
]
CITATION_DEFAULT = "refers"

# --- Repeal notes and status ------------------------------------------------
REPEAL_NOTE = (
    r"\(\s*\*\s*\)\s*(?:\(\s*\*\s*\)\s*)?"
    r"(?:Art[ií]culo|Numeral|Inciso|Literal|Ap[ae]rtado|P[aá]rrafo|Disposici[oó]n|Cap[ií]tulo|T[ií]tulo|Secci[oó]n)?"
    r"[^.]{0,60}?\b(?:derogad|d[eé]jes[ee]\s+sin\s+efecto|dejad[oa]\s+sin\s+efecto|dejar\s+sin\s+efecto|abrogad)"
)
NOTE_TAIL = r"\(\s*\*\s*\).*"
STATUS_MARKER = r"\(\*\)\s*(DEROGADO|DEJAD[OA]\s+SIN\s+EFECTO|SIN\s+EFECTO)"
MARKER_REASON_CHARS = 200
# (exact class, or fragment of the class attribute) in order of precedence
BANNER_CLASSES = [
    ("class", "alert-warning"),
    ("class", "alert-danger"),
    ("class", "alert-info"),
    ("part", "alert"),
    ("class", "notification"),
    ("class", "warning"),
    ("class", "mensaje-estado"),
    ("class", "estado-norma"),
]
BANNER_PHRASES = [
    "esta norma ha sido derogada",
    "norma derogada",
    "sin efecto",
    "no vigente",
    "anulada",
    "revocada",
    "sustituida por",
    "reemplazada por",
    "abrogada",
    "dejó sin efecto",
    "ha perdido vigencia",
    "ya no está vigente",
]
BANNER_REASON_CHARS = 80
ERROR_REASON_CHARS = 50

# --- Hierarchy levels, tested in the order given ----------------------------
LEVEL_KEYWORDS = [
    (1, ["constitucion", "reforma constitucional"]),
    (3, ["decreto supremo"]),
    (2, ["ley organica", "ley ordinaria", "decreto legislativo", "decreto de urgencia", "decreto ley",
         "codigo", "resolucion legislativa", "reglamento del congreso", "ley"]),
    (4, ["resolucion", "ordenanza", "acuerdo de concejo", "acuerdo de consejo", "acuerdo de directorio",
         "directiva", "decreto de alcaldia", "decreto regional", "decreto de consejo", "circular",
         "oficio", "edicto", "acuerdo"]),
]
LEVEL_DEFAULT = 5
LEVEL_NAMES = {1: "Constitución", 2: "Ley/Cód.", 3: "D.Supremo", 4: "Resolución", 5: "Otros"}

# --- Limits -----------------------------------------------------------------
FIELD_LIMITS = {"type": 128, "number": 128, "title": 1024, "source": 256, "status": 512,
                "url": 2048, "text_hash": 128}
MAX_TEXT_CHARS = 400_000
MIN_BLOCK_CHARS = 40
MIN_BODY_CHARS = 30
FALLBACK_BODY_CHARS = 300
SAMPLE_TEXT_CHARS = 6000
SAMPLE_RAW_CHARS = 8000
MAX_ARTICLES, MAX_CITATIONS = 500, 300
ARTICLE_CHARS, TARGET_CHARS = 8000, 256

# --- Words left out of the title word count ---------------------------------
TITLE_STOPWORDS = [
    "de", "del", "la", "el", "los", "las", "que", "en", "y", "a", "por",
    "para", "con", "se", "al", "su", "sus", "una", "un", "sobre", "o",
    "número", "nro", "no", "mediante", "decreto", "resolución", "ley",
    "norma", "aprueba", "establece",
]

# --- Labels -----------------------------------------------------------------
VALIDITY_NAMES = {1: "Vigente", 0: "Derogado"}
CITATION_LABELS = {
    "refers": "Referencias (refers)",
    "modifies": "Modificaciones (modifies)",
    "repeals": "Derogaciones (repeals)",
    "repealed_by": "Derogada por (repealed_by)",
}
TYPE_MISSING = "Sin tipo"
TITLE_PLACEHOLDER = "<Campo no disponible>"

# --- Search groups: id, label, groupings, kind of norm, historic search ------
SEARCH_GROUPS = [
    ("1", "LEGISLACIÓN DE CARACTER GENERAL",
     ["CONSTITUCION  POLITICA, LEYES  ORGANICAS Y CODIGOS",
      "NORMAS ADMINISTRATIVAS DE CARACTER PARTICULAR",
      "LEGISLACIÓN EMITIDA POR ENTIDADES VINCULADAS A LA ADMINISTRACIÓN DE JUSTICIA",
      "LEGISLACION SUPRANACIONAL",
      "JURISPRUDENCIA JUDICIAL, ADMINISTRATIVA, SUPRANACIONAL Y CONSTITUCIONAL"], "NR", False),
    ("2", "LEGISLACIÓN EMITIDA POR ENTIDADES VINCULADAS A LA ADMINISTRACIÓN DE JUSTICIA",
     ["LEGISLACIÓN EMITIDA POR ENTIDADES VINCULADAS A LA ADMINISTRACIÓN DE JUSTICIA"], "NR", False),
    ("3", "LEGISLACIÓN SUPRANACIONAL", ["LEGISLACION SUPRANACIONAL"], "NR", False),
    ("4", "NORMAS ADMINISTRATIVAS DE CARACTER PARTICULAR",
     ["NORMAS ADMINISTRATIVAS DE CARACTER PARTICULAR"], "NR", False),
    ("5", "TEXTO ÚNICO DE PROCEDIMIENTOS ADMINISTRATIVOS (TUPAS)",
     ["LEGISLACIÓN EMITIDA POR GOBIERNOS LOCALES Y REGIONALES"], "NR", False),
    ("6", "LEGISLACIÓN EMITIDA POR GOBIERNOS LOCALES Y REGIONALES",
     ["LEGISLACIÓN EMITIDA POR GOBIERNOS LOCALES Y REGIONALES"], "NR", False),
    ("7", "PERU HISTORICO", ["PERU HISTORICO"], "NR", True),
    ("8", "JURISPRUDENCIA",
     ["JURISPRUDENCIA JUDICIAL, ADMINISTRATIVA, SUPRANACIONAL Y CONSTITUCIONAL"], "JR", False),
]
ALWAYS_PRESENT_GROUPS = ["7", "8"]
GROUP_NONE = "NINGUNO"
GLOBAL_GROUP = ("GLOBAL", "GLOBAL", [], "NR", False)

# --- Sampling plan: (grouping, "1" newest first / "2" oldest first) ----------
SAMPLING_PLAN = [
    ("CONSTITUCION  POLITICA, LEYES  ORGANICAS Y CODIGOS", "1"),
    ("CONSTITUCION  POLITICA, LEYES  ORGANICAS Y CODIGOS", "2"),
    ("NORMAS ADMINISTRATIVAS DE CARACTER PARTICULAR", "1"),
    ("NORMAS ADMINISTRATIVAS DE CARACTER PARTICULAR", "2"),
    ("LEGISLACIÓN EMITIDA POR ENTIDADES VINCULADAS A LA ADMINISTRACIÓN DE JUSTICIA", "1"),
    ("LEGISLACION SUPRANACIONAL", "1"),
    ("LEGISLACIÓN EMITIDA POR GOBIERNOS LOCALES Y REGIONALES", "1"),
]

# --- Evaluation queries with their relevance keywords ------------------------
EVALUATION_QUERIES = [
    ("despido de trabajadora embarazada gestante gravidez",
     ["protección", "maternidad", "madre trabajadora", "gestante", "embarazo"]),
    ("contrato de trabajo a plazo fijo temporal",
     ["contrato de trabajo", "plazo fijo", "temporal", "laboral"]),
    ("protección del medio ambiente contaminación ambiental",
     ["medio ambiente", "ambiental", "contaminación", "ecología"]),
    ("impuesto a la renta personas naturales",
     ["impuesto", "renta", "tributo", "tributario"]),
    ("licitación pública contrataciones del estado adquisiciones",
     ["contratación", "licitación", "adquisición", "estado", "compras públicas"]),
    ("violencia contra la mujer feminicidio",
     ["violencia", "mujer", "feminicidio", "género"]),
    ("sistema nacional de salud seguro médico",
     ["salud", "seguro", "médico", "sanitario", "SIS"]),
    ("educación básica regular colegios escuelas",
     ["educación", "escuela", "colegio", "básica regular"]),
    ("inversión privada concesiones obras de infraestructura",
     ["inversión", "concesión", "infraestructura", "privado"]),
    ("procedimiento administrativo general tramite entidad pública",
     ["procedimiento administrativo", "trámite", "entidad pública", "administración"]),
    ("pension jubilacion sistema previsional AFP ONP",
     ["pensión", "jubilación", "AFP", "ONP", "previsional", "retiro"]),
    ("propiedad intelectual derechos de autor patentes marcas",
     ["propiedad intelectual", "derechos de autor", "patente", "marca"]),
]

# --- Ranking constants --------------------------------------------------------
BM25_K1, BM25_B, BM25_EPSILON = 1.5, 0.75, 0.25
CANDIDATE_FACTOR = 10
