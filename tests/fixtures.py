"""Seeded registries with planned overlaps between the five sources, at any scale.

People and companies are numbered; a source holds fixed ranges of them. At scale 1 resolution turns
310 customer rows into 250 entities and 175 supplier rows into 150; both grow with ``scale``.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldenrec.functions.documents import complete_doc, mask_doc
from goldenrec.operators import dirty

# Universe sizes and the ranges [from, to) each source holds.
PEOPLE, COMPANIES = 220, 180
PLAN: dict[tuple[str, str, str], list[tuple[int, int]]] = {
    ("empresa_a", "clientes", "PF"): [(0, 15), (25, 50)],
    ("empresa_a", "clientes", "PJ"): [(15, 35)],
    ("empresa_a", "fornecedores", "PJ"): [(0, 15), (35, 40)],
    ("empresa_b", "clientes", "PF"): [(0, 25), (60, 135)],
    ("empresa_c", "fornecedores", "PJ"): [(0, 100)],
    ("empresa_d", "clientes", "PF"): [(180, 210), (0, 20)],
    ("empresa_d", "fornecedores", "PJ"): [(100, 150), (0, 5)],
    ("empresa_e", "clientes", "PF"): [(0, 20), (135, 180), (60, 65)],
    ("empresa_e", "clientes", "PJ"): [(150, 180)],
}
# Preferred channels.
CHANNELS = ("email", "whatsapp", "instagram", "twitter")
GIVEN = ("Ana", "Bruno", "Caleb", "Débora", "Élton", "Flávia", "João", "Luísa", "Márcio", "Zoé")
FAMILY = ("Araújo", "Conceição", "da Costa", "Garcia", "Leão", "Monteiro", "Oliveira", "Vargas")
FORMS = ("Ltda.", "S.A.", "- ME", "e Filhos")
CITIES = (("Ji-Paraná", "RO"), ("São Paulo", "SP"), ("Belém", "PA"), ("Embu-Guaçu", "SP"))
AREAS = (11, 19, 48, 69, 91)
TAGS = ("novo", "parceiro", "premium", "teste")
CERTIFICATES = ("selo azul", "selo verde", "auditoria 2022", "norma interna 7")
CATEGORIES = ("parafusos", "tecidos", "tintas", "vidro")
NOTES = ("", "", "prefere carta", "telefone da loja", "nome conferido")
FIRST_DAY = "2023-01-01"


class Universe:
    """Columns of the numbered entities; every draw is a hash of seed, purpose and number."""

    def __init__(self, spark: SparkSession, scale: int = 1, seed: int = 42):
        self.spark, self.scale, self.seed = spark, scale, seed

    def draw(self, purpose: str, below: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(self.seed), F.lit(purpose), "kind", "number"), F.lit(below))

    def pick(self, purpose: str, values: tuple) -> Column:
        choices = F.array(*[F.lit(value) for value in values])
        return F.element_at(choices, self.draw(purpose, len(values)).cast("int") + 1)

    def some(self, purpose: str, values: tuple, at_most: int) -> Column:
        """The first 0..at_most values from a drawn start."""
        start = self.draw(purpose, len(values) - at_most + 1).cast("int") + 1
        size = self.draw(purpose + " size", at_most + 1).cast("int")
        return F.slice(F.array(*[F.lit(value) for value in values]), start, size)

    def entities(self, kind: str) -> DataFrame:
        size = PEOPLE if kind == "PF" else COMPANIES
        rows = self.spark.range(size * self.scale).select(F.lit(kind).alias("kind"), F.col("id").alias("number"))
        person = kind == "PF"
        place = self.draw("place", len(CITIES)).cast("int") + 1
        city = F.element_at(F.array(*[F.lit(c) for c, _ in CITIES]), place)
        state = F.element_at(F.array(*[F.lit(s) for _, s in CITIES]), place)
        ending = F.lit("") if person else F.concat(F.lit(" "), self.pick("form", FORMS))
        full = F.concat(self.pick("given", GIVEN), F.lit(" "), self.pick("family", FAMILY), ending)
        domain = F.lit("@correio.com") if person else F.lit("@empresa.com.br")
        base = F.lpad(
            F.pmod(F.col("number") * 7_919 + self.seed, F.lit(10**9 if person else 10**8)).cast("string"),
            9 if person else 8,
            "0",
        )
        return rows.select(
            "kind",
            "number",
            full.alias("name"),
            complete_doc(base if person else F.concat(base, F.lit("0001"))).alias("doc"),
            F.concat(F.lit("contato."), F.lower("kind"), F.col("number").cast("string"), domain).alias("email"),
            F.concat(
                F.lit("55"), self.pick("area", AREAS).cast("string"), (self.draw("phone", 10**8) + 9 * 10**8).cast("string")
            ).alias("phone"),
            F.concat(F.lit("Rua "), self.pick("street", FAMILY)).alias("street"),
            (self.draw("house", 9999) + 1).cast("string").alias("house"),
            F.lit("Centro").alias("quarter"),
            city.alias("city"),
            state.alias("state"),
            F.lpad(self.draw("zip", 10**8).cast("string"), 8, "0").alias("zip"),
        )

    def members(self, source: str, registry: str) -> DataFrame:
        """Entities of one source: people, then companies."""
        parts = []
        for (owner, part, kind), ranges in PLAN.items():
            if (owner, part) == (source, registry):
                number = F.col("number")
                inside = [(number >= a * self.scale) & (number < b * self.scale) for a, b in ranges]
                parts.append(self.entities(kind).where(reduce(or_, inside)))
        return reduce(DataFrame.unionByName, parts)

    def day(self, purpose: str, days: int) -> Column:
        return F.date_add(F.lit(FIRST_DAY).cast("date"), self.draw(purpose, days).cast("int"))

    def sometimes(self, purpose: str, percent: int, value: Column) -> Column:
        return F.when(self.draw(purpose, 100) < percent, value)

    def relational(self, registry: str) -> DataFrame:
        """Company A tables: typed dates, masked documents."""
        day = self.day("since", 1095)
        return self.members("empresa_a", registry).select(
            (F.col("number") * 2 + (F.col("kind") == "PJ").cast("int")).alias("id"),
            F.col("kind").alias("tipo_pessoa"),
            F.col("name").alias("nome_razao_social"),
            mask_doc("doc").alias("cpf_cnpj"),
            F.col("street").alias("endereco_rua"),
            F.col("house").alias("endereco_numero"),
            F.col("quarter").alias("endereco_bairro"),
            F.col("city").alias("endereco_cidade"),
            F.col("state").alias("endereco_uf"),
            F.col("zip").alias("endereco_cep"),
            F.col("phone").alias("telefone_principal"),
            "email",
            day.alias("data_cadastro"),
            F.when(self.draw("status", 10) < 9, "ativo").otherwise("inativo").alias("status"),
            day.cast("timestamp_ntz").alias("updated_at"),
        )

    def crm(self) -> DataFrame:
        """Company B table: no document and no address."""
        handle = F.concat(F.lit("@"), F.regexp_replace(F.lower("name"), "[^a-z]", ""))
        signup = self.day("signup", 720)
        return self.members("empresa_b", "clientes").select(
            F.col("number").alias("client_id"),
            F.col("name").alias("full_name"),
            "email",
            "phone",
            self.sometimes("instagram", 75, handle).alias("instagram_handle"),
            self.sometimes("twitter", 50, handle).alias("twitter_handle"),
            self.sometimes("facebook", 25, F.concat(F.lit("https://facebook.com/"), F.substr(handle, F.lit(2)))).alias(
                "facebook_url"
            ),
            self.pick("channel", CHANNELS).alias("preferred_channel"),
            signup.alias("signup_date"),
            F.timestamp_seconds(F.unix_timestamp(signup.cast("timestamp")) + self.draw("active", 86_400))
            .cast("timestamp_ntz")
            .alias("last_active"),
        )

    def documents(self) -> DataFrame:
        """Company C collection as one JSON text per document; optional keys are left out."""
        address = F.struct(
            F.col("street").alias("logradouro"),
            F.col("house").alias("numero"),
            F.col("quarter").alias("bairro"),
            F.col("city").alias("cidade"),
            F.col("state").alias("uf"),
            F.col("zip").alias("cep"),
        )
        bank = F.struct(F.lit("001 - BB").alias("banco"), F.lpad("house", 4, "0").alias("agencia"))
        body = F.struct(
            F.concat(F.lit("forn_"), F.col("number").cast("string")).alias("_id"),
            F.col("name").alias("razao_social"),
            mask_doc("doc").alias("cnpj"),
            F.concat(self.pick("contact", GIVEN), F.lit(" "), self.pick("contact 2", FAMILY)).alias("contato_nome"),
            F.col("phone").alias("contato_telefone"),
            F.col("email").alias("contato_email"),
            F.slice(F.concat(self.some("categories", CATEGORIES, 3), F.array(F.lit("TI"))), 1, 3).alias("categorias"),
            ((self.draw("rating", 251) + 250) / F.lit(100.0)).alias("avaliacao_media"),
            self.day("since", 1500).cast("string").alias("data_cadastro"),
            self.sometimes("certified", 66, self.some("certificates", CERTIFICATES, 3)).alias("certificacoes"),
            self.sometimes("address", 77, address).alias("endereco"),
            self.sometimes("bank", 45, bank).alias("dados_bancarios"),
            self.sometimes("note", 22, F.lit("Aguarda contrato.")).alias("observacoes"),
        )
        return self.members("empresa_c", "fornecedores").select(F.to_json(body).alias("value"))

    def spreadsheet(self, registry: str) -> DataFrame:
        """Company D file: one address text, mixed spellings, some rows twice."""
        unmasked, blank = (20, 15) if registry == "clientes" else (30, 25)
        address = F.concat(
            "street", F.lit(", "), "house", F.lit(" - "), "quarter", F.lit(", "), "city", F.lit(" - "), "state"
        )
        rows = self.members("empresa_d", registry).withColumn("again", self.draw("again", 100))
        rows = dirty.repeat_rows(rows, F.col("again"), 11)
        return rows.select(
            dirty.text_spelling("name", self.draw("spelling", 100)).alias("Nome"),
            dirty.doc_spelling("doc", self.draw("mask", 100), unmasked).alias("Documento"),
            dirty.phone_spelling("phone", self.draw("notation", 4)).alias("Fone"),
            dirty.blank_some("email", self.draw("no email", 100), blank).alias("Email"),
            address.alias("Endereco"),
            self.pick("note", NOTES).alias("Obs"),
        )

    def api(self) -> DataFrame:
        """Company E records: nested address and tags."""
        created = F.concat(self.day("created", 720).cast("string"), F.lit("T08:30:00+00:00"))
        uid = F.md5(F.concat(F.lit("api"), F.col("kind"), F.col("number").cast("string")))
        address = F.struct(
            F.col("street"),
            F.col("house").alias("number"),
            F.col("quarter").alias("neighborhood"),
            F.col("city"),
            F.col("state"),
            F.col("zip").alias("postal_code"),
            F.lit("BR").alias("country"),
        )
        return self.members("empresa_e", "clientes").select(
            uid.alias("id"),
            F.when(F.col("kind") == "PF", "individual").otherwise("business").alias("type"),
            "name",
            mask_doc("doc").alias("document"),
            "email",
            F.concat(F.lit("+"), F.col("phone")).alias("phone"),
            address.alias("address"),
            self.some("tags", TAGS, 3).alias("tags"),
            created.alias("created_at"),
            created.alias("updated_at"),
        )
