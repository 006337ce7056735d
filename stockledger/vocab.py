"""Business vocabulary, kept as data.

Every text below is a fixed value: it must equal the text found in the input files.
"""

# Voucher, family, sign in the movement balances, sign in the monthly
# consumption. SIA counts against consumption in the first and for it in the second.
VOUCHERS = [
    ("RMC - REGISTRO DE COMPRA FARMACIA", "purchases", 1, None),
    ("DC - DEVOLUCION DE COMPRA", "purchases", -1, None),
    ("EDO - ENTRADAS DONACIONES", "purchases", 1, None),
    ("EAP - ENTRADAS POR APROVECHAMIENTO", "purchases", 1, None),
    ("MIA - MOVIMIENTO INICIAL", "initial", 1, None),
    ("MIS - MOVIMIENTO INICIAL DE SALIDA", "initial", -1, None),
    ("EAS - ENTRADAS AJUSTES SOBRANTES", "adjustments", 1, None),
    ("SAF - SALIDAS AJUSTES FALTANTES", "adjustments", -1, None),
    ("EASC - ENTRADAS AJUSTES SOBRANTES CONTEO", "adjustments", 1, None),
    ("SAFC - SALIDAS AJUSTES FALTANTES CONTEO", "adjustments", -1, None),
    ("SPOE - SALIDAS POR PRESTAMOS A OTRAS ENTIDADES", "lent", 1, None),
    ("EDP - ENTRADAS POR DEVOLUCION A PRESTAMOS", "lent", -1, None),
    ("EPS - ENTRADAS PRESTAMOS SIIGO", "lent", -1, None),
    ("EPOE - ENTRADAS POR PRESTAMOS DE OTRAS ENTIDADES", "borrowed", 1, None),
    ("SDP - SALIDAS POR DEVOLUCION DE PRESTAMOS", "borrowed", -1, None),
    ("SPS - SALIDAS PRESTAMOS SIIGO", "borrowed", -1, None),
    ("ENTRADA POR TRASLADO", "transfers", 1, None),
    ("SALIDA POR TRASLADO", "transfers", -1, None),
    ("SDF - SISTEMA DISPENSACION FARMACIA", "consumption", 1, 1),
    ("SADF - SISTEMA ANULACION DISPENSACION FARMACIA", "consumption", -1, -1),
    ("SIN - SALIDAS INTERNAS FARMACIA", "consumption", 1, 1),
    ("SIA - SALIDAS INTERNAS ALMACEN", "consumption", -1, 1),
    ("EIS - ENTRADAS INTERNAS SIMA", "consumption", -1, -1),
]
TRANSFER_VOUCHER = "TEB - TRASLADOS ENTRE BODEGAS"
TRANSFER_IN = "ENTRADA POR TRASLADO"
TRANSFER_OUT = "SALIDA POR TRASLADO"
PURCHASE_VOUCHER = "RMC - REGISTRO DE COMPRA FARMACIA"
PURCHASE_RETURN_VOUCHER = "DC - DEVOLUCION DE COMPRA"
CONFIRMED = "CONFIRMADO"

# Family -> the word the movement reports use for it in their column names.
FAMILY_WORDS = {
    "purchases": "compras",
    "initial": "movimientos_iniciales",
    "adjustments": "ajustes",
    "lent": "prestamos_realizados",
    "borrowed": "prestamos_recibidos",
    "consumption": "consumos",
    "transfers": "traslados",
}
FAMILIES = list(FAMILY_WORDS)

PRODUCT = ["CodigoGenerico", "GrupoInventario", "Generico"]

# Fixed values of the movement extracts.
DISPENSED = "SISTEMA DISPENSACION FARMACIA"
RETURNED = "SISTEMA ANULACION DISPENSACION FARMACIA"
INTERNAL_OUT = ["SALIDAS INTERNAS ALMACEN", "SALIDAS INTERNAS FARMACIA"]
INTERNAL_IN = ["ENTRADAS INTERNAS FARMACIA", "ENTRADAS INTERNAS SIMA", "ENTRADAS INTERNAS ALMACEN"]
PHARMACY_BILLING = "FARMACIA"

MEDICINES = "Medicamentos"
DEVICES = "Dispositivos Medicos"
SUPPLIES = "Suministros"
OTHER_CLASS = "OTRO"
ARTICLE_CLASSES = {"1": MEDICINES, "2": DEVICES, "3": SUPPLIES}

# Services and specialties, fixed values.
GENERAL = "consultas generales"
SPECIALISED = "consultas especializadas"
PREVENTION = "pym"
CHRONIC = "cronicos"
PHARMACY = "servicio farmaceutico"
ONCOLOGY = "terapias oncologicas"
GENERAL_SPECIALTIES = ["MEDICINA GENERAL", "ODONTOLOGIA"]
NURSING = "ENFERMERIA"
ONCOLOGY_SPECIALTIES = ["ONCOLOGIA", "TERAPIAS ONCOLOGICAS"]
SERVICES_KEPT = [PREVENTION, CHRONIC, ONCOLOGY, PHARMACY]

# Audit rule -> (service, specialties, whether being one of them is the finding).
# Rule 5 looks at the doctor and not at the specialty.
AUDIT_RULES = {
    1: (GENERAL, ["MEDICINA GENERAL", "ODONTOLOGIA"], False),
    2: (SPECIALISED, ["MEDICINA GENERAL", "ODONTOLOGIA", "HIGIENE ORAL"], True),
    3: (
        PREVENTION,
        ["MEDICINA GENERAL", "ODONTOLOGIA", "HIGIENE ORAL", "ENFERMERIA", "GINECOLOGIA", "EXPERTO EN VIH"],
        False,
    ),
    4: (
        CHRONIC,
        [
            "MEDICINA INTERNA",
            "MEDICINA GENERAL",
            "ENDOCRINOLOGIA",
            "MEDICINA FAMILIAR",
            "CARDIOLOGIA",
            "NEFROLOGIA",
            "ENFERMERIA",
        ],
        False,
    ),
    5: (PHARMACY, None, None),
}


def family_vouchers(family: str) -> list[str]:
    return [text for text, fam, _, _ in VOUCHERS if fam == family]
