"""Pages in layouts of their own for op5, made of a small vocabulary; written before the labeller was trained for neutral names and not changed
since. Each function gives the markup and the blocks of the article."""

import random

WORDS = "lorem dolor amet tempor magna aliqua veniam nostrud ullamco laboris nisi commodo irure velit esse cillum fugiat nulla sint culpa".split()


class Maker:
    def __init__(self, seed):
        self.r = random.Random(seed)

    def say(self, low, high):
        return " ".join(self.r.choice(WORDS) for _ in range(self.r.randint(low, high))).capitalize() + "."

    def link(self):
        return f'<a href="/{self.r.choice(WORDS)}">{self.say(1, 4)[:-1]}</a>'

    def links(self, tag="li", low=3, high=8):
        return "".join(f"<{tag}>{self.link()}</{tag}>" for _ in range(self.r.randint(low, high)))

    def article(self, low=4, high=10):
        """(markup, blocks) of a heading and paragraphs, some with a subheading or a list."""
        title = self.say(3, 9)[:-1]
        html, blocks = f"<h1>{title}</h1>", [title]
        for _ in range(self.r.randint(low, high)):
            if self.r.random() < 0.15:
                sub = self.say(2, 6)[:-1]
                html += f"<h2>{sub}</h2>"
                blocks.append(sub)
            text = self.say(20, 70)
            html += f"<p>{text}</p>"
            blocks.append(text)
        return html, blocks

    def posts(self, name, low=2, high=6):
        """Readers' contributions: a name, a date and a text each."""
        return "".join(f'<div class="{name}"><b>{self.r.choice(WORDS).title()}</b><span>{self.r.randint(1, 28)} May</span><p>{self.say(8, 45)}</p></div>' for _ in range(self.r.randint(low, high)))

    def table_columns(self):
        html, blocks = self.article()
        side = "".join(f"<p>{self.say(4, 18)}</p>" for _ in range(self.r.randint(1, 3)))
        return f"<html><body><table><tr><td colspan=3>{self.link()} {self.link()}</td></tr><tr><td><ul>{self.links()}</ul></td><td>{html}</td><td><h3>{self.say(1, 3)}</h3>{side}<ul>{self.links()}</ul></td></tr><tr><td colspan=3>{self.say(3, 8)}</td></tr></table></body></html>", blocks

    def prose_and_discussion(self):
        html, blocks = self.article()
        return f'<html><body><div class="top">{self.link()}{self.link()}</div><div class="prose">{html}</div><div class="discussion"><h3>{self.say(1, 3)}</h3>{self.posts("msg")}</div><div class="bottom">{self.say(3, 9)}</div></body></html>', blocks

    def gdpr_and_talk(self):
        html, blocks = self.article()
        return f'<html><body><div class="gdpr"><p>{self.say(12, 30)}</p><button>OK</button></div><article>{html}</article><section class="talk"><h2>{self.say(1, 3)}</h2>{self.posts("turn")}</section></body></html>', blocks

    def main_and_teasers(self):
        html, blocks = self.article()
        tiles = "".join(f'<div class="tile"><h4>{self.link()}</h4><p>{self.say(8, 20)}</p></div>' for _ in range(self.r.randint(2, 4)))
        return f'<html><body><ul>{self.links()}</ul><main>{html}<div class="discover">{tiles}</div></main><p>{self.say(3, 8)}</p></body></html>', blocks

    def bare_body(self):
        html, blocks = self.article()
        return f"<html><body><p>{' | '.join(self.link() for _ in range(self.r.randint(3, 6)))}</p>{html}<hr><p>{' | '.join(self.link() for _ in range(self.r.randint(2, 5)))}</p></body></html>", blocks

    def numbered_names(self):
        html, blocks = self.article()
        return f'<html><body><div class="c1"><div class="c2">{self.links("span")}</div></div><div class="c3"><div class="c4">{html}</div><div class="c5"><p>{self.say(5, 15)}</p><ul>{self.links()}</ul></div></div><div class="c6">{self.say(4, 10)}</div></body></html>', blocks


KINDS = ["table_columns", "prose_and_discussion", "gdpr_and_talk", "main_and_teasers", "bare_body", "numbered_names"]


def pages(count, seed):
    """(kind, markup, article text) of count pages of each kind."""
    for kind in KINDS:
        for i in range(count):
            html, blocks = getattr(Maker(f"{seed}-{kind}-{i}"), kind)()
            yield kind, html, "\n".join(blocks)
