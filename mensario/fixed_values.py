"""Values the results depend on; changing one changes what the book means.

Labels, patterns, window lengths, table names and lake folders are part of the
data contract with the people who read the tables, so they are stated here once
and referred to everywhere else.
"""

# Subjects of the raw zone and the trusted tables they feed.
SUBJECT_FATURAS = "tb_faturas"
SUBJECT_PAGAMENTOS = "tb_pagamentos"
TRUSTED_FATURAS = "tb_0001_fatura"
TRUSTED_PAGAMENTOS = "tb_0002_pagamentos"

# Identifier prefixes to strip, as patterns.
PREFIX_TO_LAST_HYPHEN = ".*-"
PREFIX_OF_TWO_HYPHENS = ".*-.*-"

# Classes by payment date, in the order the features are numbered.
NO_PRAZO = "PAGAMENTO_NO_PRAZO"
ANTECIPADO = "PAGAMENTO_ANTECIPADO"
SEM_PAGAMENTO = "SEM_PAGAMENTO"
EM_ATRASO = "PAGAMENTO_EM_ATRASO"
CLASSES_PAGTO = (NO_PRAZO, ANTECIPADO, SEM_PAGAMENTO, EM_ATRASO)

# Classes by amount paid, in the order the features are numbered.
VALOR_TOTAL = "VALOR_TOTAL"
VALOR_PARCIAL = "VALOR_PARCIAL"
SEM_VALOR = "SEM_VALOR"
CLASSES_VLR_PAGTO = (VALOR_TOTAL, VALOR_PARCIAL, SEM_VALOR)

# Look-back windows in months, and how far back the book reads.
JANELAS_MESES = (1, 3, 6, 9, 12)
MESES_BOOK = 12

# Days-late value of a payment made before its due date.
DIAS_ANTECIPADO = -1
