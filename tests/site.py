"""A small hand-made news site in the markup the site rules expect."""


def card(url="/a", title="Заголовок", date="18 октября 2024", text="Текст", image="/i.jpg"):
    href = f' href="{url}"' if url is not None else ""
    return "".join([
        '<article class="elementor-post elementor-grid-item">',
        f'<div class="elementor-post__thumbnail"><img data-src="{image}" src="data:lazy"></div>' if image else "",
        f'<h3 class="elementor-post__title"> <a{href}> {title} </a></h3>' if title is not None else "",
        f'<span class="elementor-post-date"> {date} </span>' if date is not None else "",
        f'<div class="elementor-post__excerpt"><p>{text}</p></div>' if text is not None else "",
        "</article>"])


def page(*cards, next_url=None):
    link = f'<nav class="elementor-pagination"><a class="page-numbers next" href="{next_url}">→</a></nav>' if next_url else ""
    return f'<html><body><div class="elementor-posts-container">{"".join(cards)}</div>{link}</body></html>'
