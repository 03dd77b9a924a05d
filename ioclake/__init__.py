"""ioclake: security-article intelligence as Spark DataFrame jobs.

Landed web pages and documents go in; links, articles, sentences, tokens,
indicators of compromise, entity mentions, actors, analysis requests and
replies, and corpus-level report tables come out.  Every public function
takes DataFrames and returns a DataFrame without triggering an action.
"""

__version__ = "0.1.0"
