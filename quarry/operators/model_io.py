"""Model request and reply tables.

The model call itself is outside Spark: requests are written as a table,
replies come back as a table and are joined on the request id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry import params as P
from quarry.functions import text as T
from quarry.functions.fold import ascii_fold

# The system prompt for journal issues.
JOURNAL_PROMPT = """Prompt for generating a news story from a description
        
Objective: generate a 300-word news story based on the provided text of a research articles with some abstracts for that publications edition of things they researched.

Do not refer to this entire text as one research article as they are a collection of a couple research articles.
    
Never use the word 'recent.' Do not include journal page numbers or individual submission dates in the story. Do not discuss the peer review process.

"""

# The system prompt for public comment letters; %s is the
# prompt date ("MMMM, d" of as_of).
COMMENT_PROMPT = """Prompt for Generating a News Story from a Letter

Objective: Generate a 400-word news story based on the provided text of a letter to a U.S. federal agency. Adhere strictly to the following formatting and content rules.
Input: Text from a letter addressed to a federal agency.
Formatting and Content Instructions:

Headline:
Create a headline in Title Case that summarizes the core issue of the letter.
The headline must be on its own line.
Do not place a period or any other punctuation at the end of the headline.

Article Structure:
Place a single line break between the headline and the first paragraph of the story.
The first paragraph must begin with the following text exactly: WASHINGTON, %s --
The total word count should be up to 400 words.

Agency and Organization Names:
In the first paragraph, focus on the company or entity that issued the public comment letter to the federal agency, which should also be named. Use the full name of the federal agency that received the letter. If the agency is a department, prefix it with "U.S." instead of spelling out "United States" (e.g., "U.S. Department of Justice").
In first reference, use public comment letter
In all subsequent paragraphs, refer to that agency using only an appropriate acronym or a synonym (e.g., "the agency," "the commission").
In all instances, use only straight quotes, not curly or slanted quotes.

Quoted Material:
Avoid using direct quotes in quotation marks from the letter, but attribute material to the organization/entity sending the letter.
Avoid using the names of people.

Style and Word Choice:
Always refer to the District of Columbia as "D.C."
Do not use any of the following words in the story: Mr., Ms., Hon., Dr., new, recently, honorable, significant, forthcoming, extensive, formal, formally, detailed, thereof.
Execute these instructions without relying on any text OUTSIDE of this document.
Follow all previous directions exactly with no deviation"""

MODEL_NAME = "gpt-4o-mini"


def prompt_dateline(as_of: Column) -> Column:
    """M2: the comment prompt with the date inserted."""
    return F.replace(F.lit(COMMENT_PROMPT), F.lit("%s"), F.date_format(as_of, "MMMM, d"))


def build_requests(df: DataFrame, id_cols, user_text: str, system_prompt: Column) -> DataFrame:
    """M1: one request per record: [system, user] messages."""
    msgs = F.array(F.struct(F.lit("system").alias("role"), system_prompt.alias("content")),
                   F.struct(F.lit("user").alias("role"), F.col(user_text).alias("content")))
    return df.select(*id_cols, F.lit(MODEL_NAME).alias("model"), msgs.alias("messages"))


def journal_requests(issues: DataFrame, id_cols, abstract_texts: str = "abstract_texts") -> DataFrame:
    """M1 for journals: the abstracts of an issue record in one text, asked with the journal prompt.
    Records without text are not asked."""
    d = issues.withColumn("_said", F.array_join(F.col(abstract_texts), " ")).where(F.length("_said") > 0)
    return build_requests(d, id_cols, "_said", F.lit(JOURNAL_PROMPT))


def consume_replies(requests: DataFrame, replies: DataFrame, keys, pdf_text: str, link: str,
                    reply: str = "reply", signers=P.SIGNER_PHRASES) -> DataFrame:
    """M3: J7 then T1, T8, P11, T6, T7, T9; adds headline, body, box,
    signer_comment and reason (null = usable)."""
    j = requests.join(replies, list(keys), "left")
    cleaned = ascii_fold(F.col(reply))
    head, rest = T.split_reply(cleaned)
    body = T.story_body(rest, F.col(link))
    post, phrase = T.signer_split(F.col(pdf_text), signers)
    j = j.select("*", head.alias("headline"), body.alias("body"),
                 post.alias("post_signer"), phrase.alias("signer_phrase"))
    return j.select(
        "*",
        T.route_box(F.col("post_signer"), F.col("body")).alias("box"),
        T.signer_comment(F.col("post_signer"), F.col("signer_phrase")).alias("signer_comment"),
        F.when(F.col(reply).isNull(), F.lit("no_reply"))
         .when(F.col("body").isNull(), F.lit("reply_without_newline")).alias("reply_reason"))
