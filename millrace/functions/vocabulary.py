"""Fixed values of the lexical rules: word lists and phrases whose content decides results."""

from __future__ import annotations

# Words that carry no content, English then Italian.
STOPWORDS = """
a an the of to in on for and or is are be been was were it its this that these those as at by from with not no but if then than
so such can could may might will would should does do did has have had there which what when where who how why into about also
only any all we you they he she i us them their our your
il lo la i gli le un uno una di da del della dei delle dello degli al allo alla ai agli alle dal dalla dai nel nella nei nelle
sul sulla con per tra fra che chi cui non come dove quando quale quali questo questa questi queste quel quello quella essere sono
e ed o ma se anche piu più molto puo può deve viene vengono essa esso si ci ne su una ha hanno
""".split()

# Technical words that any answer may use.
GENERIC = """
http https api apis rest json yaml yml xml sql get post put patch delete head options crud url uri id ids uuid db sdk cli ui ux ok
todo fixme note readme md env ci cd tls ssl dns cpu gpu ram io os pr mr utc iso rfc faq and/or e/o n/a ndr
""".split()

# Phrases that state a gap, one per line, matched in normalised text.
REFUSALS = """
does not contain
do not contain
doesn't contain
not contain
not enough information
insufficient information
no information
does not specify
doesn't specify
not specified
not documented
is not covered
no mention
cannot be determined
cannot determine
can't determine
does not say
doesn't say
not available in the
outside the provided
not present in the provided
non contiene
non contengono
non specifica
non specificano
non indica
non indicano
non riporta
non riportano
non documenta
non è documentat
non sono documentat
non sufficient
non è sufficiente
non sono sufficienti
informazioni insufficienti
non permette di determinare
non consente di determinare
non sono present
non è present
non viene specificat
non compare
non emerge dalla documentazione
nessuna informazione
non e possibile stabilire
non è possibile stabilire
non e possibile determinare
non è possibile determinare
non e possibile rispondere
non è possibile rispondere
non ho elementi
non posso rispondere
non posso dedur
non posso escludere
non posso dire
non compare in nessuna
non descrivono
non dicono nulla
non c'e nulla
non c'è nulla
non ci sono
va verificato
non dice nulla
non e trattat
non permettono di
non permette di
non e determinabile
non è determinabile
non determinabile
servirebbero
mancano i
mancano le
mancano gli
mancano l
non consentono di
non sono desumibil
non si puo stabilire
non si può stabilire
non è trattat
non e ricavabile
non è ricavabile
non risulta document
is not stated
are not described
do not describe
cannot be answered
no reference to
would require
cannot answer
none of them
is not enough
are not enough
not mentioned
none of the supplied
none of the provided
is silent on
are silent on
will not guess
is not covered by
not documented in
cannot be determined from
is not determinable
do not allow
does not allow determining
these blocks do not
the blocks do not
would be needed
""".strip().split("\n")

# Phrases that name a conflict between sources.
CONFLICTS = "contradict|conflicting|in conflict|inconsistent|contraddi|contrastant|in conflitto|incoerent|discordant".split("|")

# Categories (the last five are kept for older rows), difficulties and answerabilities of an example.
CATEGORIES = """
how_it_works api service dependency architecture database data_flow configuration integration error_handling bug_investigation
multi_source partially_answerable unanswerable contradictory_context extension_guidance route dependencies integrations errors comparison
""".split()
DIFFICULTIES = ("easy", "medium", "hard")
ANSWERABLE = ("full", "partial", "none")

# The shapes of project-specific identifiers, a code span, a citation and a word.
IDENTIFIERS = (
    r"\b[A-Z][a-z0-9]+(?:[A-Z][a-z0-9]+)+\b",
    r"\b[A-Za-z][A-Za-z0-9]*(?:_[A-Za-z0-9]+)+\b",
    r"\b[a-zA-Z_]\w*(?:\.[a-zA-Z_]\w*)+\b",
    r"(?<![\w/])/[A-Za-z][A-Za-z0-9_\-{}:/]*",
    r"\b[A-Z]{3,}\b",
)
CODE_SPAN = r"`([^`\n]{1,80})`"
CITATION = r"\[([^\[\]\n]+?)\s+[—–-]\s+([^\[\]\n]+?)\]"
WORD = r"[A-Za-z0-9_][A-Za-z0-9_./-]*"
