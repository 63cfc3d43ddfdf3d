"""Word lists and lookup values that results depend on."""

# Words that carry no topic in comments about a person.
GENERIC_NOISE = [
    "parabéns", "parabens", "lindo", "linda", "excelente", "maravilhoso",
    "maravilha", "emocionante", "emoção", "amei", "ótimo", "otimo", "incrível",
    "incrivel", "sensacional", "espetacular", "show", "top", "gostei",
    "adorei", "perfeito", "perfeita", "demais", "brilhante",
    "deus", "jesus", "cristo", "abençoe", "abencoe", "amém", "amem",
    "oração", "oracao", "reze", "rezar", "orando", "glória", "gloria",
    "misericórdia", "misericordia", "bênção", "bencao", "proteja", "protege",
    "vamos", "juntos", "força", "forca", "cima", "tudo", "todos", "sempre",
    "tmj", "bora", "avante", "querido", "querida",
    "vai", "vou", "vao", "vamo", "vem", "pra", "pro",
    "fica", "ficar", "ficou", "ficam", "fazer", "faz",
]

# Markers a platform leaves in place of removed content.
REMOVED_MARKERS = ["[removed]", "[deleted]"]
REMOVED_TOKENS = ["removed", "deleted"]

# The closed domains of the relational model.
DOCUMENT_TYPES = ["video", "post", "comentario", "resposta", "anuncio"]
TERM_TYPES = ["alias", "handle", "hashtag", "consulta", "canal"]
MODEL_TYPES = ["topico", "sentimento"]
MODEL_STATUSES = ["treinando", "vigente", "arquivado"]
RUN_STATUSES = ["em_execucao", "sucesso", "parcial", "falha"]
POLARITIES = ["negativo", "neutro", "positivo"]

# Class label of an annotated comment -> code.
LABEL_CODES = {"Negativo": 0, "Neutro": 1, "Positivo": 2}
PENDING_LABEL = "PENDENTE"

# Sources (code, name), raw collection -> source, source -> modelled document type.
SOURCES = [("youtube", "YouTube"), ("reddit", "Reddit"), ("meta", "Meta Ads")]
COLLECTION_SOURCE = {"reddit": "reddit", "meta": "meta", "youtube_comments": "youtube"}
MODELLED_TYPE = {"meta": "anuncio", "reddit": "post", "youtube": "comentario"}

# Folder name of an encoder -> (short key, full model name).
ENCODERS = {
    "sentence_transformers_all_minilm_l12_v2":
        ("minilm_l12", "sentence-transformers/all-MiniLM-L12-v2"),
    "sentence_transformers_paraphrase_multilingual_mpnet_base_v2":
        ("mpnet_multi", "sentence-transformers/paraphrase-multilingual-mpnet-base-v2"),
    "qwen_qwen3_embedding_0_6b":
        ("qwen3_0_6b", "Qwen/Qwen3-Embedding-0.6B"),
    "ricardoz_bertugues_base_portuguese_cased":
        ("bertugues", "ricardoz/BERTugues-base-portuguese-cased"),
}

# The combination that is registered as the current model.
CURRENT_K = 15
CURRENT_ENCODER = "qwen3_0_6b"

# How letters and signs without an accent decomposition are written in ASCII.
ASCII_SPELLING = {
    "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ð": "d", "đ": "d", "ø": "o", "ł": "l",
    "ı": "i", "ħ": "h", "ŋ": "ng",
    "–": "-", "—": "--", "‘": "'", "’": "'", "“": '"', "”": '"', "…": "...",
    "«": "<<", "»": ">>", "¡": "!", "¿": "?", "´": "'", "°": "deg", "€": "EUR", "£": "PS",
    "©": "(c)", "®": "(r)", "™": "tm", "·": "*", "•": "*", "×": "x", "÷": "/", "§": "SS",
    "¼": "1/4", "½": "1/2", "¾": "3/4",
}
